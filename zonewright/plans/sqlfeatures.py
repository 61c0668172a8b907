"""The features of the catalogue as SQL, relational instead of vectorised: the oracle of the feature queries."""

from __future__ import annotations

from collections.abc import Sequence

from ..functions.ngrams import REFERENCE, STATISTICS
from ..functions.registry import DEFAULT_NAMES

_CHARS = "|".join(f"{c}+" for c in "abcdefghijklmnopqrstuvwxyz0123456789-_")
_RUN = "coalesce(list_max(list_transform(regexp_extract_all({0}, '{1}'), lambda x: length(x))), 0)"


def catalogue_names() -> list[str]:
    """All features that SQL has here."""
    return sorted([*_lexical(), *(f"{n}G_{x}" for n in REFERENCE for x in STATISTICS)])


def _count(text: str, keep: str) -> str:
    return f"length(regexp_replace({text}, '[^{keep}]', '', 'g'))"


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE {a}::DOUBLE / {b} END"


def _lexical() -> dict[str, str]:
    letters = "regexp_replace(fqdn, '[^a-z]', '', 'g')"
    vowels, n = _count(letters, "aeiou"), f"length({letters})"
    cons = "b-df-hj-np-tv-z"
    chars = "list_distinct(string_split(fqdn, ''))"
    share = "(length(fqdn) - length(replace(fqdn, x, '')))::DOUBLE / length(fqdn)"
    kinds = {"CON": cons, "LET": "a-z", "NUM": "0-9", "VOW": "aeiou"}
    by_level = {}
    for level, text in (("FQDN", "fqdn"), ("2LD", "sld"), ("OLD", "old")):
        by_level[f"N_LEN_{level}"] = f"length({text})"
        by_level |= {f"N_{k}_{level}": _ratio(_count(text, keep), f"length({text})") for k, keep in kinds.items()}
        by_level[f"N_SYM_{level}"] = _ratio(f"length(regexp_replace({text}, '[a-z0-9]', '', 'g'))", f"length({text})")
    return by_level | {
        "L_NUM_LABELS": "len(labels)", "L_LEN_TLD": "length(coalesce(labels[-1], ''))", "L_UNIQUE_CHARS": f"CASE WHEN fqdn = '' THEN 0 ELSE len({chars}) END",
        "L_HYPHEN_RATIO": _ratio("length(regexp_replace(fqdn, '[^-]', '', 'g'))", "length(fqdn)"), "L_VOWEL_RATIO_LETTERS": _ratio(vowels, n),
        "L_CONSONANT_RATIO_LETTERS": _ratio(f"({n} - {vowels})", n),
        "L_ENTROPY": f"CASE WHEN fqdn = '' THEN 0 ELSE -list_sum(list_transform({chars}, lambda x: {share} * log2({share}))) END",
        "L_HAS_HYPHEN": "CASE WHEN contains(fqdn, '-') THEN 1 ELSE 0 END",
        "L_LC_C": _RUN.format("fqdn", f"[{cons}]+"), "L_LC_D": _RUN.format("fqdn", "[0-9]+"), "L_LC_V": _RUN.format("fqdn", "[aeiou]+"),
        "L_LEN_LABEL_MAX": "coalesce(list_max(list_transform(labels, lambda x: length(x))), 0)",
        "L_LEN_LABEL_MIN": "coalesce(list_min(list_transform(labels, lambda x: length(x))), 0)",
        "L_MAX_CHAR_RUN": _RUN.format("fqdn", _CHARS),
        "L_MAX_CONSONANT_RUN_LETTERS": _RUN.format(letters, f"[{cons}]+"), "L_MAX_VOWEL_RUN_LETTERS": _RUN.format(letters, "[aeiou]+"),
        "L_NUM_DOTS": "greatest(len(labels) - 1, 0)",
        "L_UNIQUE_RATIO": _ratio(f"CASE WHEN fqdn = '' THEN 0 ELSE len({chars}) END", "length(fqdn)"),
        "L_VC_ALTERNATIONS": f"greatest(len(regexp_extract_all({letters}, '[aeiou]+|[^aeiou]+')) - 1, 0)",
    }


def _grams(n: int, names: Sequence[str]) -> tuple[str, dict[str, str]]:
    ref = ", ".join(f"('{g}', {float(w)}::DOUBLE)" for g, w in REFERENCE[n].items())
    total = sum(map(float, REFERENCE[n].values()))
    q = f"(w / {total}::DOUBLE)"
    ctes = f"""
g{n} AS (SELECT id, substr(core, i, {n}) AS g, count(*) AS c FROM (SELECT id, core, unnest(range(1, length(core) - {n} + 2)) AS i FROM pieces) GROUP BY ALL),
r{n} AS (SELECT * FROM (VALUES {ref}) AS t(g, w)),
o{n} AS (SELECT id, count(*) AS k, sum(c)::DOUBLE AS s1, sum(c * c)::DOUBLE AS s2, sum(c * c * c)::DOUBLE AS s3, sum(c * c * c * c)::DOUBLE AS s4,
  count(*) FILTER (c > 1) AS rep, log2(sum(c)) - sum(c * log2(c)) / sum(c) AS e, quantile_cont(c::DOUBLE, 0.25) AS q25, quantile_cont(c::DOUBLE, 0.5) AS q50, quantile_cont(c::DOUBLE, 0.75) AS q75 FROM g{n} GROUP BY id),
u{n} AS (SELECT id, g, coalesce(c, 0)::DOUBLE AS c, coalesce(w, 0)::DOUBLE AS w, coalesce(s1, 0) AS s1, CASE WHEN coalesce(s1, 0) = 0 THEN 0 ELSE coalesce(c, 0) / s1 END AS p
  FROM (SELECT id, g FROM g{n} UNION SELECT id, g FROM pieces, r{n}) LEFT JOIN g{n} USING (id, g) LEFT JOIN r{n} USING (g) LEFT JOIN o{n} USING (id)),
e{n} AS (SELECT id, sum(abs(run)) AS em FROM (SELECT id, sum(p - {q}) OVER (PARTITION BY id ORDER BY g) AS run FROM u{n}) GROUP BY id),
v{n} AS (SELECT id, count(*) AS m, sum(p * {q}) - sum(p) * sum({q}) / count(*) AS cov, sum(p * p) - sum(p) ** 2 / count(*) AS pv, sum({q} * {q}) - sum({q}) ** 2 / count(*) AS qv,
  sum({q}) AS t1, sum({q} ** 2) AS t2, sum({q} ** 3) AS t3, sum({q} ** 4) AS t4,
  sum(CASE WHEN p > 0 THEN p * ln((p + 1e-12::DOUBLE) / ({q} + 1e-12::DOUBLE)) ELSE 0 END) AS kl, sum(CASE WHEN p > 0 THEN p * ln({q} + 1e-12::DOUBLE) ELSE 0 END) AS pro,
  sum(abs(p - {q}) / (p + {q} + 1e-12::DOUBLE)) AS ca, max(abs(p - {q})) AS ch, sqrt(sum((p - {q}) ** 2)) AS eu, sum(abs(p - {q})) AS ma, count(*) FILTER (c > 0 AND w > 0) AS ji FROM u{n} GROUP BY id),
m{n} AS (SELECT id, c, w, count(*) AS n FROM u{n} GROUP BY ALL),
k{n} AS (SELECT a.id, sum(a.n * b.n * sign(a.c - b.c) * sign(a.w - b.w)) AS s, sum(a.n * b.n * abs(sign(a.c - b.c))) AS x, sum(a.n * b.n * abs(sign(a.w - b.w))) AS y
  FROM m{n} a JOIN m{n} b ON a.id = b.id GROUP BY a.id),
w{n} AS (SELECT id, avg(a * b) - avg(a) * avg(b) AS ab, avg(a * a) - avg(a) ** 2 AS aa, avg(b * b) - avg(b) ** 2 AS bb FROM (SELECT id,
  rank() OVER (PARTITION BY id ORDER BY c) + (count(*) OVER (PARTITION BY id, c) - 1) / 2.0::DOUBLE AS a, rank() OVER (PARTITION BY id ORDER BY w) + (count(*) OVER (PARTITION BY id, w) - 1) / 2.0::DOUBLE AS b FROM u{n}) GROUP BY id),
s{n} AS (SELECT id, k * s2 - s1 * s1 AS m2, k * k * s3 - 3 * k * s1 * s2 + 2 * s1 ** 3 AS m3,
  k ** 3 * s4 - 4 * k * k * s1 * s3 + 6 * k * s1 * s1 * s2 - 3 * s1 ** 4 AS m4 FROM o{n}),
f{n} AS (SELECT id, CASE WHEN m2 > 0 THEN m3 / m2 ** 1.5 ELSE 0 END AS ske, CASE WHEN m2 > 0 THEN m4 / (m2 * m2) - 3 ELSE 0 END AS kur FROM s{n})"""
    mean = "(t1 / m)"
    var = f"(t2 / m - {mean} ** 2)"
    cols = {
        "50P": "q50 / s1", "MEAN": "1 / k::DOUBLE", "QMEAN": "sqrt(s2 / k) / s1", "SUMSQ": "s2 / s1 ** 2", "E": "e", "DST_JI": "ji / m::DOUBLE",
        "PVAR": "(k * s2 - s1 * s1) / (k * s1) ** 2", "PSTD": "sqrt(k * s2 - s1 * s1) / (k * s1)", "VAR": "CASE WHEN k > 1 THEN (k * s2 - s1 * s1) / (k * (k - 1) * s1 ** 2) END",
        "STD": "CASE WHEN k > 1 THEN sqrt((k * s2 - s1 * s1) / (k * (k - 1))) / s1 END", "COV": "cov / m", "SPE": "CASE WHEN aa > 1e-9::DOUBLE THEN ab / sqrt(aa * bb) END",
        "TSUM": "t1", "TSUMSQ": "t2", "TPVAR": var, "TPSTD": f"sqrt({var})", "TVAR": f"{var} * m / (m - 1)", "TSTD": f"sqrt({var} * m / (m - 1))",
        "TSKE": f"(t3 / m - 3 * {mean} * t2 / m + 2 * {mean} ** 3) / {var} ** 1.5", "25P": "q25 / s1", "75P": "q75 / s1", "DIST": "k", "REP": "rep", "DST_CA": "ca", "DST_CH": "ch", "DST_EM": "em", "DST_EU": "eu",
        "DST_KL": "kl", "DST_MA": "ma", "PRO": "pro", "SKE": "ske", "KUR": "kur",
        "KEN": "CASE WHEN x * y > 0 THEN s / sqrt(x::DOUBLE * y::DOUBLE) ELSE 0 END",
        "NORM": "CASE WHEN k > 1 THEN k / 6 * ske ** 2 + k / 24 * kur ** 2 ELSE 0 END",
        "PEA": "CASE WHEN pv > 1e-15::DOUBLE THEN cov / sqrt(pv * qv) ELSE 0 END",
        "TKUR": f"(t4 / m - 4 * {mean} * t3 / m + 6 * {mean} ** 2 * t2 / m - 3 * {mean} ** 4) / {var} ** 2 - 3",
    }
    wanted = [x[3:] for x in names if x.startswith(f"{n}G_")]
    final = ", ".join(f'coalesce({cols[x]}, 0)::DOUBLE AS "{n}G_{x}"' for x in wanted)
    ctes += f",\nd{n} AS (SELECT v.id, {final} FROM v{n} v JOIN e{n} USING (id) JOIN k{n} USING (id) JOIN w{n} USING (id) LEFT JOIN o{n} USING (id) LEFT JOIN f{n} USING (id))"
    return ctes, {f"{n}G_{x}": f'd{n}."{n}G_{x}"' for x in wanted}


def feature_ctes(source: str, digits: int = 9, names: Sequence[str] = DEFAULT_NAMES) -> str:
    """CTEs up to ``featured(id, <features>)``; ``source`` names a relation with ``id, domain``."""
    parts = f"""
split_ AS (SELECT id, list_filter(string_split(trim(lower(domain), '.'), '.'), lambda x: x <> '') AS labels FROM {source}),
pieces AS (SELECT id, labels, array_to_string(labels, '') AS fqdn, CASE WHEN len(labels) > 1 THEN labels[-2] ELSE coalesce(labels[1], '') END AS sld,
  CASE WHEN len(labels) > 2 THEN array_to_string(labels[1:len(labels) - 2], '') ELSE '' END AS old, regexp_replace(array_to_string(labels, ''), '[^a-z]', '', 'g') AS core FROM split_)"""
    exprs = _lexical()
    for n in (1, 2, 3):
        ctes, cols = _grams(n, names)
        parts += "," + ctes
        exprs |= cols
    select = ", ".join(f'round(({exprs[x]})::DOUBLE, {digits}) + 0.0 AS "{x}"' for x in names)
    return parts + f",\nfeatured AS (SELECT p.id, {select} FROM pieces p JOIN d1 USING (id) JOIN d2 USING (id) JOIN d3 USING (id))"
