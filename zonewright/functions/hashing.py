"""Deterministic hashes as Columns: the same value on every engine that knows SHA-256."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import _c

#: 2**64 - 1 and the like, for hashes taken as unsigned numbers.
UINT64_MAX = 18446744073709551615


def sha_text(*parts: Column | str | int) -> Column:
    """SHA-256, in hex, of the parts joined by colons; plain values are literals."""
    return F.sha2(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]), 256)


def uint64(hex_digest: Column) -> Column:
    """First 8 bytes of a digest as an unsigned number, DECIMAL(20, 0)."""
    return F.conv(F.substring(hex_digest, 1, 16), 16, 10).cast("decimal(20,0)")


def uint32(hex_digest: Column) -> Column:
    """First 4 bytes of a digest as an unsigned number, BIGINT."""
    return F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("bigint")


def stable_seed(base: Column | int, text: Column) -> Column:
    """64-bit seed of a text, e.g. a file's path."""
    return uint64(sha_text(base, text))


def derived_seed(base: Column | int, counter: Column, salt: Column | str) -> Column:
    return uint64(sha_text(base, counter.cast("string"), salt))


def int_seed(text: Column) -> Column:
    """32-bit seed of a text."""
    return uint32(F.sha2(text, 256))


def order_hash(seed: Column | int, algorithm: Column | str, domain: Column | str) -> Column:
    """Sort key that orders the names of a group at random, but always alike."""
    return sha_text(seed, _c(algorithm), _c(domain))


def ratios_ok(train: float, validation: float, test: float) -> bool:
    return train > 0 and validation >= 0 and test > 0 and abs(train + validation + test - 1) <= 1e-9


def split_of(domain: Column | str, seed: int = 42, train: float = 0.8, validation: float = 0.1, test: float = 0.1) -> Column:
    """``train``, ``validation`` or ``test``, from the name alone, so independent of any order."""
    if not ratios_ok(train, validation, test):
        raise ValueError("ratios must be positive (validation may be 0) and add up to 1")
    u = uint64(sha_text(seed, _c(domain))).cast("double") / float(UINT64_MAX)
    return F.when(u < train, "train").when(u < train + validation, "validation").otherwise("test")


def row_digest(*cols: Column) -> Column:
    """Integrity hash of a row: SHA-256 of its values joined by commas."""
    return F.sha2(F.concat_ws(",", *[c.cast("string") for c in cols]), 256)


def md5_chunks(text: Column) -> Column:
    """The four 8-digit pieces of an MD5."""
    h = F.md5(text)
    return F.transform(F.sequence(F.lit(1), F.lit(25), F.lit(8)), lambda i: F.substring(h, i, F.lit(8)))
