"""The features of one name in plain Python, from their definitions."""

import math
from collections import Counter
from itertools import combinations, groupby
from statistics import fmean

from zonewright.functions.ngrams import REFERENCE

EPS = 1e-12


def div(a, b):
    return a / b if b else 0.0


def moments(x):
    """Population variance, skewness, excess kurtosis of whole numbers or weights."""
    if len(set(x)) < 2:
        return 0.0, 0.0, 0.0
    m = fmean(x)
    v = fmean((a - m) ** 2 for a in x)
    return v, fmean((a - m) ** 3 for a in x) / v**1.5, fmean((a - m) ** 4 for a in x) / v**2 - 3


def quantile(x, q):
    x, at = sorted(x), q * (len(x) - 1)
    if not x:
        return 0.0
    return x[math.floor(at)] + (x[math.ceil(at)] - x[math.floor(at)]) * (at - math.floor(at))


def correlation(x, y):
    if len(set(x)) < 2 or len(set(y)) < 2:
        return 0.0
    a, b = fmean(x), fmean(y)
    return sum((s - a) * (t - b) for s, t in zip(x, y)) / math.sqrt(sum((s - a) ** 2 for s in x) * sum((t - b) ** 2 for t in y))


def ranks(x):
    return [sum(b < a for b in x) + (x.count(a) + 1) / 2 for a in x]


def tau(x, y):
    s = tx = ty = 0
    for (a, b), (c, d) in combinations(list(zip(x, y)), 2):
        sign = ((a > c) - (a < c)) * ((b > d) - (b < d))
        s += sign
        tx += a != c
        ty += b != d
    return div(s, math.sqrt(tx * ty))


def grams(core, n):
    counts = Counter(core[i : i + n] for i in range(len(core) - n + 1))
    total, k = sum(counts.values()), len(counts)
    f = [c / total for c in counts.values()]
    v, skew, kurt = moments(list(counts.values()))
    v = v / total**2 if total else 0.0
    keys = sorted(set(counts) | set(REFERENCE[n]))
    w = [REFERENCE[n].get(g, 0) for g in keys]
    c = [counts[g] for g in keys]
    p, q = [div(x, total) for x in c], [x / sum(w) for x in w]
    tv, tskew, tkurt = moments(q)
    diff, run, moved = [a - b for a, b in zip(p, q)], 0.0, 0.0
    for d in diff:
        run += d
        moved += abs(run)
    u, pm, qm = len(keys), fmean(p), fmean(q)
    sample = v * k / (k - 1) if k > 1 else 0.0
    out = {
        "DIST": k, "REP": sum(x > 1 for x in counts.values()), "25P": quantile(f, 0.25), "50P": quantile(f, 0.5), "75P": quantile(f, 0.75),
        "MEAN": div(1, k), "QMEAN": math.sqrt(fmean(x * x for x in f)) if f else 0, "SUMSQ": sum(x * x for x in f), "VAR": sample, "PVAR": v,
        "STD": math.sqrt(sample), "PSTD": math.sqrt(v), "SKE": skew, "KUR": kurt, "E": -sum(x * math.log2(x) for x in f),
        "NORM": k / 6 * skew**2 + k / 24 * kurt**2 if k > 1 else 0, "PRO": sum(a * math.log(b + EPS) for a, b in zip(p, q) if a),
        "COV": fmean((a - pm) * (b - qm) for a, b in zip(p, q)), "PEA": correlation(c, w), "SPE": correlation(ranks(c), ranks(w)), "KEN": tau(c, w),
        "TSUM": sum(q), "TSUMSQ": sum(x * x for x in q), "TVAR": tv * u / (u - 1), "TPVAR": tv, "TSTD": math.sqrt(tv * u / (u - 1)), "TPSTD": math.sqrt(tv),
        "TSKE": tskew, "TKUR": tkurt, "DST_KL": sum(a * math.log((a + EPS) / (b + EPS)) for a, b in zip(p, q) if a),
        "DST_CA": sum(abs(a - b) / (a + b + EPS) for a, b in zip(p, q)), "DST_CH": max(map(abs, diff)), "DST_EU": math.sqrt(sum(d * d for d in diff)),
        "DST_MA": sum(map(abs, diff)), "DST_EM": moved, "DST_JI": len(set(counts) & set(REFERENCE[n])) / u,
    }
    return {f"{n}G_{s}": x for s, x in out.items()}


def longest(text, test):
    return max((len(list(g)) for hit, g in groupby(text, test) if hit), default=0)


def features(domain):
    labels = [x for x in domain.lower().strip().strip(".").split(".") if x]
    fqdn = "".join(labels)
    sld = labels[-2] if len(labels) > 1 else fqdn
    vowel, letter = set("aeiou"), set("abcdefghijklmnopqrstuvwxyz")
    consonant = letter - vowel
    letters = [x for x in fqdn if x.isalpha()]
    v = sum(x in vowel for x in letters)
    shares = [fqdn.count(x) / len(fqdn) for x in set(fqdn)]
    out = {
        "L_NUM_LABELS": len(labels), "L_NUM_DOTS": max(len(labels) - 1, 0), "L_LEN_LABEL_MAX": max(map(len, labels), default=0),
        "L_LEN_LABEL_MIN": min(map(len, labels), default=0), "L_LEN_TLD": len(labels[-1]) if labels else 0, "L_HYPHEN_RATIO": div(fqdn.count("-"), len(fqdn)),
        "L_HAS_HYPHEN": "-" in fqdn, "L_UNIQUE_CHARS": len(set(fqdn)), "L_UNIQUE_RATIO": div(len(set(fqdn)), len(fqdn)),
        "L_MAX_CHAR_RUN": max((len(list(g)) for _, g in groupby(fqdn)), default=0), "L_VC_ALTERNATIONS": max(len(list(groupby(letters, vowel.__contains__))) - 1, 0),
        "L_VOWEL_RATIO_LETTERS": div(v, len(letters)), "L_CONSONANT_RATIO_LETTERS": div(len(letters) - v, len(letters)),
        "L_MAX_VOWEL_RUN_LETTERS": longest(letters, vowel.__contains__), "L_MAX_CONSONANT_RUN_LETTERS": longest(letters, lambda x: x not in vowel),
        "L_ENTROPY": -sum(x * math.log2(x) for x in shares), "L_LC_C": longest(fqdn, consonant.__contains__), "L_LC_V": longest(fqdn, vowel.__contains__),
        "L_LC_D": longest(fqdn, str.isdigit),
    }
    for level, text in (("FQDN", fqdn), ("2LD", sld), ("OLD", "".join(labels[:-2]))):
        out[f"N_LEN_{level}"] = len(text)
        for kind, test in (("CON", consonant.__contains__), ("LET", letter.__contains__), ("NUM", str.isdigit), ("VOW", vowel.__contains__), ("SYM", lambda x: x not in letter and not x.isdigit())):
            out[f"N_{kind}_{level}"] = div(sum(map(test, text)), len(text))
    core = "".join(x for x in fqdn if x in letter)
    for n in (1, 2, 3):
        out |= grams(core, n)
    return {k: float(x) for k, x in out.items()}
