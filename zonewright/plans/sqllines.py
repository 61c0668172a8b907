"""SQL for reading list files: delimiters, headers, widths, reasons, names, as DuckDB says it."""

from __future__ import annotations

from ..functions.names import BLANKS

_STRIP = "trim({0}, '" + BLANKS + "')"
_CUT = "regexp_replace(regexp_replace({0}, '^\"|\"$', '', 'g'), '\"\"', '\"', 'g')"


def _split(line: str, delim: str) -> str:
    """Fields of a sound line: delimiters inside quotes are set aside while it is split."""
    parts = f"string_split({line}, '\"')"
    masked = f"array_to_string(list_transform({parts}, lambda x, i: CASE WHEN i % 2 = 0 THEN replace(x, {delim}, chr(1)) ELSE x END), '\"')"
    return f"list_transform(string_split({masked}, {delim}), lambda x: replace(x, chr(1), {delim}))"


def _sound(line: str, delim: str) -> str:
    """Whether quotes are closed, stand around whole fields, and are doubled inside: doubled ones are taken out of
    quoted parts first, then every field is quoted as a whole or holds no quote."""
    fields = _split(line, delim)
    return (
        f"((length({line}) - length(replace({line}, '\"', ''))) % 2 = 0 AND "
        f"len(list_filter({fields}, lambda x: contains(x, '\"') AND NOT regexp_full_match(x, '\"[^\"]*(\"\"[^\"]*)*\"', 's'))) = 0)"
    )


def line_ctes() -> str:
    """``lines``, ``config``, ``schemas``, and ``celled_``: every line with its fields, name cell and row reason."""
    n = ", ".join(f"sum(CASE WHEN NOT blank AND line_no <= 30 THEN length(line) - length(replace(line, {c}, '')) ELSE 0 END) AS {k}" for k, c in (("n0", "','"), ("n1", "chr(9)"), ("n2", "';'"), ("n3", "'|'")))
    low_cells = f"list_transform(CASE WHEN {_sound('line', 'delim')} THEN {_split('line', 'delim')} ELSE string_split(line, delim) END, lambda x: lower({_STRIP.format(_CUT.format('x'))}))"
    return f"""lines AS (SELECT *, {_STRIP.format('line')} = '' AS blank FROM
      (SELECT file_id, line_no, coalesce(CASE WHEN line_no = 1 THEN regexp_replace(raw_line, '^' || chr(65279), '') ELSE raw_line END, '') AS line FROM raw_lines)),
    config AS (SELECT file_id, arg_min(struct_pack(d := delimiter, c := domain_column, h := header_auto_detect), coalesce(domain_column, '')) AS c FROM parse_config GROUP BY file_id),
    counted AS (SELECT file_id, {n}, min(line_no) FILTER (NOT blank) AS first_no FROM lines GROUP BY file_id),
    facts AS (SELECT k.file_id, first_no, line, CASE WHEN c.d <> '' THEN c.d WHEN m = 0 THEN NULL WHEN n0 = m THEN ',' WHEN n1 = m THEN chr(9) WHEN n2 = m THEN ';' ELSE '|' END AS delim,
      lower({_STRIP.format('c.c')}) AS wanted, coalesce(c.h, false) AS auto
      FROM (SELECT *, greatest(n0, n1, n2, n3) AS m FROM counted) k LEFT JOIN config USING (file_id) LEFT JOIN lines l ON l.file_id = k.file_id AND l.line_no = k.first_no),
    celled AS (SELECT *, CASE WHEN delim IS NOT NULL AND line IS NOT NULL THEN {low_cells} END AS cells FROM facts),
    headed AS (SELECT *, cells IS NOT NULL AND (wanted IS NOT NULL OR (auto AND list_has_any(cells, ['domain', 'hostname', 'fqdn', 'host']))) AS has_header FROM celled),
    widths AS (SELECT file_id, arg_max(width, n * 100000 - width) AS usual FROM (SELECT l.file_id, len({_split('l.line', 'h.delim')}) AS width, count(*) AS n FROM lines l JOIN headed h USING (file_id)
      WHERE NOT l.blank AND h.delim IS NOT NULL AND NOT has_header AND {_sound('l.line', 'h.delim')} GROUP BY ALL) GROUP BY file_id),
    schemas AS (SELECT file_id, delim, CASE WHEN has_header THEN first_no END AS header_line, coalesce(CASE WHEN has_header THEN len(cells) END, usual, 1)::INT AS columns,
      greatest(CASE WHEN has_header AND wanted IS NOT NULL THEN coalesce(list_position(cells, wanted), 0) - 1 ELSE 0 END, 0)::INT AS name_index,
      has_header AND wanted IS NOT NULL AND coalesce(list_position(cells, wanted), 0) = 0 AS column_missing FROM headed LEFT JOIN widths USING (file_id)),
    data AS (SELECT l.*, s.*  EXCLUDE (file_id), CASE WHEN l.blank THEN 'blank' WHEN l.line_no IS NOT DISTINCT FROM header_line THEN 'header' ELSE 'data' END AS line_kind,
      delim IS NULL OR {_sound('l.line', 'delim')} AS sound FROM lines l JOIN schemas s USING (file_id)),
    split_ AS (SELECT *, CASE WHEN delim IS NULL THEN [line] WHEN sound THEN {_split('line', 'delim')} END AS fields FROM data),
    celled_ AS (SELECT *, CASE WHEN delim IS NULL THEN line WHEN sound AND len(fields) > name_index THEN CASE WHEN starts_with(fields[name_index + 1], '\"') THEN {_CUT.format('fields[name_index + 1]')} ELSE fields[name_index + 1] END END AS cell,
      CASE WHEN line_kind <> 'data' THEN NULL WHEN delim IS NOT NULL AND column_missing THEN 'domain_column_missing' WHEN NOT sound THEN 'broken_quoting' WHEN delim IS NOT NULL AND len(fields) <> columns THEN 'column_count' END AS row_reason FROM split_)"""


def told_cte(normal: str) -> str:
    """``told``: kind and reason of every line, names in the normal form given (``{0}`` is the cell)."""
    label = "[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"
    bad = f"list_filter(list_transform(string_split(x, '.'), lambda l: CASE WHEN l = '' THEN 'empty_label' WHEN length(l) > 63 THEN 'label_too_long' WHEN NOT regexp_full_match(l, '{label}') THEN 'invalid_character' END), lambda r: r IS NOT NULL)"
    return f"""named AS (SELECT *, CASE WHEN line_kind = 'data' AND row_reason IS NULL THEN {normal.format('cell')} END AS x FROM celled_),
    told AS (SELECT file_id, line_no, line_kind, row_reason, x, name_index, fields, columns, CASE WHEN row_reason IS NOT NULL THEN row_reason WHEN line_kind <> 'data' THEN NULL WHEN x = '' THEN 'empty' WHEN length(x) > 253 THEN 'too_long'
      WHEN contains(x, '..') THEN 'double_dot' WHEN NOT contains(x, '.') THEN 'invalid_suffix' WHEN len({bad}) > 0 THEN ({bad})[1]
      WHEN NOT regexp_full_match(string_split(x, '.')[-1], '[a-z]{{2,63}}') THEN 'invalid_suffix' END AS reason FROM named)"""
