"""N-gram features of names: one Arrow UDF, vectorised over all names of a batch.

Per name there are two vectors over the union of its n-grams and a reference distribution, and 36
statistics of them. Counts stay whole numbers as long as possible: moments are taken from sums of
powers of counts, so a variance is zero exactly if all counts are equal, on every engine.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

EPS = 1e-12
# The reference weights of n-grams, in percent or relative.
REFERENCE: dict[int, dict[str, float]] = {
    1: {
        "e": 12.0, "t": 9.1, "a": 8.2, "o": 7.5, "i": 7.0, "n": 6.7, "s": 6.3, "h": 6.1, "r": 6.0, "d": 4.3, "l": 4.0, "c": 2.8, "u": 2.8,
        "m": 2.4, "w": 2.4, "f": 2.2, "g": 2.0, "y": 2.0, "p": 1.9, "b": 1.5, "v": 1.0, "k": 0.8, "j": 0.15, "x": 0.15, "q": 0.10, "z": 0.07,
    },
    2: {"th": 10, "he": 9, "in": 8, "er": 7, "an": 7, "re": 6, "on": 6, "at": 5, "en": 5, "nd": 5},
    3: {"the": 10, "and": 8, "ing": 7, "her": 5, "ion": 5, "ent": 4, "tha": 4, "nth": 3},
}
# The statistics of each n.
STATISTICS = (
    "DIST", "REP", "25P", "50P", "75P", "MEAN", "QMEAN", "SUMSQ", "VAR", "PVAR", "STD", "PSTD", "SKE", "KUR", "E", "NORM", "PRO",
    "COV", "PEA", "SPE", "KEN", "TSUM", "TSUMSQ", "TVAR", "TPVAR", "TSTD", "TPSTD", "TSKE", "TKUR",
    "DST_KL", "DST_CA", "DST_CH", "DST_EU", "DST_MA", "DST_EM", "DST_JI",
)
_CHUNK = 4096


def _div(a, b):
    a, b = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float))
    return np.divide(a, b, out=np.zeros(a.shape), where=b != 0)


def _same_counts(row, count, n):
    """For each row, pairs of equal counts: row and count are coded as one whole number."""
    base = int(count.max(initial=0)) + 1
    code, size = np.unique(row * base + count, return_counts=True)
    return np.bincount(code // base, size * (size - 1) / 2, minlength=n)


def _ranks(row, value):
    """Average ranks within each row, less a constant of the row."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    new = np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])]
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    last = np.cumsum(size)
    out = np.empty(len(row))
    out[order] = (last - (size - 1) / 2)[group]
    return out


def _standard(s1, s2, s3, s4, n):
    """Population variance, skewness and excess kurtosis from sums of powers (0 if no variance)."""
    mean = _div(s1, n)
    m2 = _div(s2, n) - mean**2
    m3 = _div(s3, n) - 3 * mean * _div(s2, n) + 2 * mean**3
    m4 = _div(s4, n) - 4 * mean * _div(s3, n) + 6 * mean**2 * _div(s2, n) - 3 * mean**4
    m2 = np.where(m2 > 1e-18, m2, 0.0)
    return m2, _div(m3, m2**1.5), np.where(m2 > 0, _div(m4, m2**2) - 3, 0.0)


def ngram_statistics(letters: list[str], n: int, wanted: Collection[str] = STATISTICS) -> dict[str, np.ndarray]:
    """Statistics of ``n``-grams for a list of strings over a-z: at least those wanted. What costs a sort or
    a pass over pairs is left out unless it is asked for."""
    size, asked = len(letters), set(wanted)
    out: dict[str, np.ndarray] = {}
    sums = lambda row, w: np.bincount(row, w, minlength=size)
    length = np.fromiter(map(len, letters), np.int64, size)
    code = np.frombuffer("".join(letters).encode(), np.uint8).astype(np.int64) - 97
    owner = np.repeat(np.arange(size), length)
    base = 26**n
    take = max(len(code) - n + 1, 0)
    gram, whole = np.zeros(take, np.int64), owner[:take] == owner[n - 1 :][:take]
    for j in range(n):
        gram = gram * 26 + code[j : j + take]
    keys, count = np.unique((owner[:take] * base + gram)[whole], return_counts=True)
    row = keys // base
    k, total = np.bincount(row, minlength=size), sums(row, count)

    # observed frequencies
    s1, s2, s3, s4 = (np.rint(sums(row, count.astype(float) ** e)).astype(np.int64) for e in (1, 2, 3, 4))
    m2 = (k * s2 - s1 * s1).astype(float)
    m3 = (k * k * s3 - 3 * k * s1 * s2 + 2 * s1**3).astype(float)
    m4 = (k**3 * s4 - 4 * k * k * s1 * s3 + 6 * k * s1 * s1 * s2 - 3 * s1**4).astype(float)
    out["DIST"], out["REP"] = k.astype(float), sums(row, (count > 1).astype(float))
    quartiles = [(name, q) for name, q in (("25P", 0.25), ("50P", 0.5), ("75P", 0.75)) if name in asked]
    if quartiles:
        widest = int(count.max(initial=0)) + 1
        ordered, start = (np.sort(row * widest + count) % widest).astype(float), np.r_[0, np.cumsum(k)[:-1]]
    for name, q in quartiles:
        at = q * np.maximum(k - 1, 0)
        lo, hi = np.floor(at).astype(int), np.ceil(at).astype(int)
        v = np.zeros(size)
        some = k > 0
        a, b = ordered[(start + lo)[some]], ordered[(start + hi)[some]]
        v[some] = (a + (b - a) * (at - lo)[some]) / total[some]
        out[name] = v
    out["MEAN"], out["QMEAN"], out["SUMSQ"] = _div(1.0, k) * (k > 0), _div(np.sqrt(_div(s2, k)), total), _div(s2, total**2)
    out["PVAR"] = _div(m2, k.astype(float) ** 2 * total**2)
    out["VAR"] = _div(m2, k * np.maximum(k - 1, 0) * total**2)
    out["STD"], out["PSTD"] = np.sqrt(out["VAR"]), np.sqrt(out["PVAR"])
    out["SKE"] = _div(m3, m2**1.5)
    out["KUR"] = np.where(m2 > 0, _div(m4, m2**2) - 3, 0.0)
    if "E" in asked:
        p_obs = count / total[row]
        out["E"] = -sums(row, p_obs * np.log2(p_obs))
    out["NORM"] = np.where(k > 1, k / 6 * out["SKE"] ** 2 + k / 24 * out["KUR"] ** 2, 0.0)

    # union with the reference, in the order of the grams
    names = sorted(REFERENCE[n])
    refs = len(names)
    weight = np.array([float(REFERENCE[n][g]) for g in names])
    ref_code = np.array([sum((ord(ch) - 97) * 26 ** (n - 1 - j) for j, ch in enumerate(g)) for g in names])
    # both lists are sorted and without repeats, so one merge tells where each stands in the union
    ref_keys = (np.arange(size)[:, None] * base + ref_code).ravel()
    at = np.searchsorted(keys, ref_keys)
    held = at < len(keys)
    held[held] = keys[at[held]] == ref_keys[held]
    union = np.sort(np.r_[keys, ref_keys[~held]])
    mine, theirs = np.searchsorted(union, keys), np.searchsorted(union, ref_keys)
    c, w = np.zeros(len(union)), np.zeros(len(union))
    c[mine], w[theirs] = count, np.tile(weight, size)
    u = union // base
    m = np.bincount(u, minlength=size)
    p, q = _div(c, total[u]), w / weight.sum()
    seen = c > 0
    if "PRO" in asked:
        out["PRO"] = sums(u[seen], p[seen] * np.log(q[seen] + EPS))
    flat = (m * s2 == s1 * s1)  # all counts over the union are equal
    if asked & {"COV", "PEA"}:
        pd_, qd = p - _div(sums(u, p), m)[u], q - _div(sums(u, q), m)[u]
        cov, pv, qv = sums(u, pd_ * qd), np.where(flat, 0.0, sums(u, pd_ * pd_)), sums(u, qd * qd)
        out["COV"], out["PEA"] = cov / m, _div(cov, np.sqrt(pv * qv))
    if "SPE" in asked:
        rc, rw = _ranks(u, c), _ranks(u, w)
        rc, rw = rc - (sums(u, rc) / m)[u], rw - (sums(u, rw) / m)[u]
        out["SPE"] = _div(sums(u, rc * rw), np.sqrt(np.where(flat, 0.0, sums(u, rc * rc)) * sums(u, rw * rw)))
    if "KEN" in asked:
        # pairs of which one gram is a reference gram; the others are tied in the reference
        falling = np.argsort(-weight, kind="stable")
        at_ref, ranked = c[theirs].reshape(size, refs)[:, falling], weight[falling]
        agree = np.zeros(size)
        for i in range(refs):
            lower = ranked < ranked[i]
            if lower.any():
                agree += np.sign(at_ref[:, i : i + 1] - at_ref[:, lower]).sum(axis=1)
        other = w == 0
        agree += sums(u[other], np.sign(at_ref[u[other]] - c[other][:, None]).sum(axis=1))
        pairs, alike = m * (m - 1) / 2, np.unique(weight, return_counts=True)[1]
        same_weight = (m - refs) * (m - refs - 1) / 2 + (alike * (alike - 1) / 2).sum()
        out["KEN"] = _div(agree, np.sqrt((pairs - _same_counts(u, c.astype(np.int64), size)) * (pairs - same_weight)))
    t1, t2, t3, t4 = (float(((weight / weight.sum()) ** e).sum()) for e in (1, 2, 3, 4))
    out["TSUM"], out["TSUMSQ"] = np.full(size, t1), np.full(size, t2)
    out["TPVAR"], out["TSKE"], out["TKUR"] = _standard(t1, t2, t3, t4, m)
    out["TVAR"] = out["TPVAR"] * m / (m - 1)
    out["TSTD"], out["TPSTD"] = np.sqrt(out["TVAR"]), np.sqrt(out["TPVAR"])
    out["DST_KL"] = sums(u[seen], p[seen] * np.log((p[seen] + EPS) / (q[seen] + EPS)))
    diff = p - q
    out["DST_CA"] = sums(u, np.abs(diff) / (p + q + EPS))
    first = np.r_[0, np.cumsum(m)[:-1]]
    out["DST_CH"] = np.maximum.reduceat(np.abs(diff), first)
    out["DST_EU"], out["DST_MA"] = np.sqrt(sums(u, diff * diff)), sums(u, np.abs(diff))
    if "DST_EM" in asked:
        run = np.cumsum(diff)
        run -= (run[first] - diff[first])[u]
        out["DST_EM"] = sums(u, np.abs(run))
    out["DST_JI"] = sums(u, (seen & (w > 0)).astype(float)) / m
    return out


def compute(letters: pd.Series, names: list[str]) -> pd.DataFrame:
    """The named features (``1G_DIST`` and so on) of each string; nulls count as empty."""
    wanted = {n: [x for x in names if x[0] == str(n)] for n in (1, 2, 3)}
    frames = []
    for at in range(0, len(letters), _CHUNK):
        texts = [t or "" for t in letters.iloc[at : at + _CHUNK]]
        cols: dict[str, np.ndarray] = {}
        for n, mine in wanted.items():
            if mine:
                stats = ngram_statistics(texts, n, [x.split("_", 1)[1] for x in mine])
                cols |= {x: stats[x.split("_", 1)[1]] for x in mine}
        frames.append(pd.DataFrame(cols, columns=names))
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=names, dtype=float)


def ngram_features(letters: Column, names: list[str]) -> Column:
    """Struct of the named features."""
    ship_package(SparkSession.getActiveSession())
    schema = ", ".join(f"`{x}` double" for x in names)

    @F.pandas_udf(schema)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield compute(b, names)

    return udf(letters)
