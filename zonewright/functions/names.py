"""The three name policies as Column expressions.

``list_*``   names of list files: BOM dropped, trimmed, lower case, all trailing dots removed
``strict_*`` generated names: trimmed, lower case, one trailing dot removed, IDNA where it converts
``final_*``  names of the final data set: as above with all trailing dots, IDNA failure rejects

Null in, null out, except where a reason is returned (null is the reason ``none``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank when text is stripped.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK_CLASS = r"[\s\x1c-\x1f\x85\p{Z}]"
_PLAIN = r"\A[a-z0-9_][a-z0-9_.-]*[a-z0-9_-]\z"
_LABEL = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
#: TLD patterns of the list policy.
LIST_SUFFIX = {"lenient": "[a-z0-9-]{2,63}", "balanced": "[a-z]{2,63}", "strict": "[a-z]{2,24}"}
REASONS = (
    "none", "empty", "too_long", "double_dot", "invalid_suffix", "empty_label",
    "label_too_long", "invalid_character",
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove every blank of Unicode from both ends (plain ``trim`` knows only the space)."""
    return F.trim(_c(c), F.lit(BLANKS))


def key_form(c: Column | str) -> Column:
    """A code, class or source name as it is compared: stripped, lower case, blank as null."""
    k = F.lower(strip(c))
    return F.when(k != "", k)


def idna(c: Column) -> Column:
    """IDNA (2003) form of a name with non-ASCII characters, null if it does not convert."""
    return F.call_function("try_reflect", F.lit("java.net.IDN"), F.lit("toASCII"), c, F.lit(1))


def without_one_dot(c: Column) -> Column:
    return F.when(c.endswith("."), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)


def strict_name(c: Column | str, convert: bool = True) -> Column:
    """Normal form of a generated name; names that are in it already skip every step. Without ``convert``, names
    other than ASCII stay so."""
    raw = _c(c)
    n = without_one_dot(F.lower(strip(raw)))
    full = F.when(n.rlike(r"[^\x00-\x7f]"), F.coalesce(idna(n), n)).otherwise(n) if convert else n
    return F.when(raw.rlike(_PLAIN), raw).otherwise(full)


def name_key(c: Column | str) -> Column:
    """``strict_name`` with empty names as null: what duplicates are looked up by."""
    n = strict_name(c)
    return F.when(n != "", n)


def _label_reason(x: Column) -> Column:
    return (
        F.when(x == "", F.lit("empty_label"))
        .when(F.length(x) > 63, F.lit("label_too_long"))
        .when(~x.rlike(r"\A[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\z"), F.lit("invalid_character"))
    )


def strict_reason(raw: Column | str, normal: Column | None = None) -> Column:
    """First reason why a generated name is refused, null if it is valid.

    ``normal`` is ``strict_name(raw)`` where the caller has it already.
    """
    raw = _c(raw)
    n = strict_name(raw) if normal is None else normal
    bad = F.filter(F.transform(F.split(n, r"\."), _label_reason), lambda r: r.isNotNull())
    good = n.rlike(rf"\A(?:{_LABEL}\.)+[a-z]{{2,63}}\z") & (F.length(n) <= 253)
    return (
        F.when(raw.isNull(), F.lit("none"))
        .when(good, F.lit(None).cast("string"))
        .when(n == "", F.lit("empty"))
        .when(F.length(n) > 253, F.lit("too_long"))
        .when(F.contains(n, F.lit("..")), F.lit("double_dot"))
        .when(~F.contains(n, F.lit(".")), F.lit("invalid_suffix"))
        .otherwise(F.coalesce(F.try_element_at(bad, F.lit(1)), F.lit("invalid_suffix")))
    )


def strict_validate(c: Column | str) -> Column:
    """``struct(is_valid, normalized, reason)`` of a generated name."""
    raw = _c(c)
    n = strict_name(raw)
    reason = strict_reason(raw, n)
    return F.struct(
        reason.isNull().alias("is_valid"),
        F.when(reason.isNull(), n).alias("normalized"),
        reason.alias("reason"),
    )


def precheck_reason(c: Column | str) -> Column:
    """Reason of the check made before validation: all trailing dots are removed first."""
    raw = _c(c)
    n = F.regexp_replace(F.lower(strip(raw)), r"\.+\z", "")
    return (
        F.when(raw.isNull(), F.lit("none"))
        .when(n == "", F.lit("empty"))
        .when(F.contains(n, F.lit("..")), F.lit("double_dot"))
        .when(n.startswith("."), F.lit("empty_label"))
    )


def list_name(c: Column | str) -> Column:
    """Normal form of a name from a list file; no IDNA."""
    n = F.lower(strip(F.translate(_c(c), "\ufeff", "")))
    return F.regexp_replace(n, r"\.+\z", "")


def list_valid(normal: Column | str, strictness: Column | str = "balanced") -> Column:
    """Whether a normalised list name is valid; strictness is one policy or a column of them
    (unknown and null values count as balanced)."""
    n = _c(normal)
    fits = lambda p: n.rlike(rf"\A(?:{_LABEL}\.)+{p}\z")
    if isinstance(strictness, str):
        chosen = fits(LIST_SUFFIX.get(strictness, LIST_SUFFIX["balanced"]))
    else:
        chosen = (
            F.when(strictness == "lenient", fits(LIST_SUFFIX["lenient"]))
            .when(strictness == "strict", fits(LIST_SUFFIX["strict"]))
            .otherwise(fits(LIST_SUFFIX["balanced"]))
        )
    return F.coalesce(chosen & (F.length(n) <= 253), F.lit(False))


def final_name(c: Column | str) -> Column:
    """Normal form of a name for the final data set, null if it is refused. One label is enough."""
    n = F.regexp_replace(F.lower(strip(_c(c))), r"\.+\z", "")
    n = F.when(~n.rlike(BLANK_CLASS) & ~F.contains(n, F.lit(",")), n)
    n = F.when(n.rlike(r"[^\x00-\x7f]"), idna(n)).otherwise(n)
    return F.when(n.rlike(rf"\A{_LABEL}(?:\.{_LABEL})*\z") & (F.length(n) <= 253), n)


def sanitized(c: Column | str) -> Column:
    """A name without its empty labels."""
    return F.array_join(F.filter(F.split(_c(c), r"\."), lambda x: x != ""), ".")


def suffix(c: Column | str) -> Column:
    """What follows the last dot, '' without a dot."""
    d = _c(c)
    return F.when(F.contains(d, F.lit(".")), F.substring_index(d, ".", -1)).otherwise(F.lit(""))


def header_form(c: Column | str) -> Column:
    """A header cell reduced to lower-case letters and digits."""
    return F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]", "")
