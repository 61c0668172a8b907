"""Lexical features of a name as Column expressions, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import strip

LEVELS = ("FQDN", "2LD", "OLD")
KINDS = {"CON": "[^b-df-hj-np-tv-z]", "LET": "[^a-z]", "NUM": r"[^\p{Nd}]", "SYM": r"[a-z\p{Nd}]", "VOW": "[^aeiou]"}
_NUMBERS = ("LEN", "CON", "LET", "NUM", "SYM", "VOW")


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b == 0, 0.0).otherwise(a / b)


def longest_run(text: Column, pattern: str) -> Column:
    """Length of the longest match."""
    runs = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda r: F.length(r))
    return F.coalesce(F.array_max(runs), F.lit(0)).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for no text."""
    n = F.length(text).cast("double")
    share = lambda ch: (n - F.length(F.replace(text, ch, F.lit("")))) / n
    chars = F.array_distinct(F.filter(F.split(text, ""), lambda ch: ch != ""))
    sums = F.aggregate(F.transform(chars, share), F.lit(0.0), lambda a, p: a - p * F.log2(p))
    return F.when(n > 0, sums).otherwise(0.0)


def parts(domain: Column) -> dict[str, Column]:
    """Pieces of a name. ``fqdn`` is all labels without the dots, ``old`` those before the second level."""
    d = F.regexp_replace(strip(F.lower(domain)), r"\A\.+|\.+\z", "")
    labels = F.filter(F.split(d, r"\."), lambda x: x != "")
    return {"domain": d, "labels": labels}


def pieces(labels: Column) -> dict[str, Column]:
    n = F.size(labels)
    fqdn = F.array_join(labels, "")
    return {
        "fqdn": fqdn,
        "tld": F.coalesce(F.get(labels, n - 1), F.lit("")),
        "sld": F.coalesce(F.when(n >= 2, F.get(labels, n - 2)).otherwise(F.get(labels, F.lit(0))), F.lit("")),
        "old": F.when(n > 2, F.array_join(F.slice(labels, F.lit(1), F.greatest(n - 2, F.lit(0))), "")).otherwise(F.lit("")),
        "core": F.regexp_replace(fqdn, "[^a-z]", ""),
    }


def lexical_features(p: dict[str, Column]) -> dict[str, Column]:
    """Name -> expression of all 37 lexical features, from the columns of ``pieces`` and ``labels``."""
    f, labels = p["fqdn"], p["labels"]
    n = F.size(labels)
    sizes = F.transform(labels, lambda x: F.length(x))
    letters = F.regexp_replace(f, r"[^\p{L}]", "")
    vowels, n_letters = F.length(F.regexp_replace(letters, "[^aeiou]", "")), F.length(letters)
    unique = F.size(F.array_distinct(F.filter(F.split(f, ""), lambda ch: ch != "")))
    hyphens = F.length(F.regexp_replace(f, "[^-]", ""))
    out = {
        "L_NUM_LABELS": n,
        "L_NUM_DOTS": F.greatest(n - 1, F.lit(0)),
        "L_LEN_LABEL_MAX": F.coalesce(F.array_max(sizes), F.lit(0)),
        "L_LEN_LABEL_MIN": F.coalesce(F.array_min(sizes), F.lit(0)),
        "L_LEN_TLD": F.length(p["tld"]),
        "L_HYPHEN_RATIO": ratio(hyphens, F.length(f)),
        "L_HAS_HYPHEN": (hyphens > 0).cast("int"),
        "L_UNIQUE_CHARS": unique,
        "L_UNIQUE_RATIO": ratio(unique, F.length(f)),
        "L_MAX_CHAR_RUN": longest_run(f, r"(?s)(.)\1*+"),
        "L_VC_ALTERNATIONS": F.greatest(F.size(F.regexp_extract_all(letters, F.lit("[aeiou]++|[^aeiou]++"), F.lit(0))) - 1, F.lit(0)),
        "L_VOWEL_RATIO_LETTERS": ratio(vowels, n_letters),
        "L_CONSONANT_RATIO_LETTERS": ratio(n_letters - vowels, n_letters),
        "L_MAX_VOWEL_RUN_LETTERS": longest_run(letters, "[aeiou]++"),
        "L_MAX_CONSONANT_RUN_LETTERS": longest_run(letters, "[^aeiou]++"),
        "L_ENTROPY": entropy(f),
        "L_LC_C": longest_run(f, "[b-df-hj-np-tv-z]++"),
        "L_LC_V": longest_run(f, "[aeiou]++"),
        "L_LC_D": longest_run(f, r"\p{Nd}++"),
    }
    for level, text in zip(LEVELS, (f, p["sld"], p["old"]), strict=True):
        for kind in _NUMBERS:
            size = F.length(text)
            out[f"N_{kind}_{level}"] = size if kind == "LEN" else ratio(F.length(F.regexp_replace(text, KINDS[kind], "")), size)
    return {k: v.cast("double") for k, v in out.items()}
