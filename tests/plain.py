"""Plain single-threaded statements of the semantics, to compare the operators with."""

from collections import Counter, defaultdict


def strict_name(value):
    if value is None:
        return None
    n = value.strip().lower()
    n = n[:-1] if n.endswith(".") else n
    try:
        return n.encode("idna").decode("ascii") if n else n
    except UnicodeError:
        return n


def strict_reason(value):
    if value is None:
        return "none"
    n = strict_name(value)
    if not n:
        return "empty"
    if len(n) > 253:
        return "too_long"
    if ".." in n:
        return "double_dot"
    labels = n.split(".")
    if len(labels) < 2:
        return "invalid_suffix"
    for x in labels:
        if not x:
            return "empty_label"
        if len(x) > 63:
            return "label_too_long"
        if x[0] == "-" or x[-1] == "-" or not all(c.isascii() and (c.islower() or c.isdigit() or c == "-") for c in x):
            return "invalid_character"
    return None if len(labels[-1]) > 1 and labels[-1].isalpha() else "invalid_suffix"


def fields(line, delim):
    """Fields of a line, None if its quoting is broken."""
    out, at = [], 0
    while True:
        if line.startswith('"', at):
            text, at = "", at + 1
            while True:
                end = line.find('"', at)
                if end < 0:
                    return None
                text += line[at:end]
                at = end + 1
                if not line.startswith('"', at):
                    break
                text, at = text + '"', at + 1
        else:
            end = line.find(delim, at)
            end = len(line) if end < 0 else end
            text, at = line[at:end], end
            if '"' in text:
                return None
        out.append(text)
        if at == len(line):
            return out
        if not line.startswith(delim, at):
            return None
        at += len(delim)


def classify(lines, config):
    """lines: (file_id, line_no, text); config: file_id -> (delimiter, domain_column, auto)."""
    files = defaultdict(list)
    for f, n, x in sorted(lines, key=lambda r: r[:2]):
        files[f].append((n, (x or "").removeprefix("﻿") if n == 1 else x or ""))
    for f, rows in files.items():
        delim, column, auto = config.get(f, (None, None, None))
        if not delim:
            sniffed = [x for n, x in rows if n <= 30 and x.strip()]
            score, delim = max(((sum(x.count(d) for x in sniffed), d) for d in ",\t;|"), key=lambda s: s[0])
            delim = delim if score else None
        full = [(n, x) for n, x in rows if x.strip()]
        header, index, width, missing = None, 0, None, False
        if delim and full:
            cells = [c.strip().lower() for c in fields(full[0][1], delim) or full[0][1].split(delim)]
            if column and column.strip() or auto and {"domain", "hostname", "fqdn", "host"} & set(cells):
                header, width = full[0][0], len(cells)
                if column and column.strip():
                    missing = column.strip().lower() not in cells
                    index = -1 if missing else cells.index(column.strip().lower())
            else:
                widths = Counter(len(p) for _, x in full if (p := fields(x, delim)))
                width = min(widths, key=lambda w: (-widths[w], w)) if widths else 1
        for n, x in rows:
            if not x.strip():
                yield f, n, "blank", None, None
                continue
            if n == header:
                yield f, n, "header", None, None
                continue
            if not delim:
                reason, name = strict_reason(x), x
            elif missing:
                reason = "domain_column_missing"
            elif (parts := fields(x, delim)) is None:
                reason = "broken_quoting"
            elif len(parts) != width:
                reason = "column_count"
            else:
                name = parts[index]
                reason = strict_reason(name)
            yield f, n, "invalid" if reason else "valid", None if reason else strict_name(name), reason
