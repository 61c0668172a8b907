from plain import strict_name, strict_reason
from zonewright.functions import names as nm

VALUES = [None, "", ".", "..", " 　", "a.b.", "a..b", "-a.com", "a-.com", "a" * 64 + ".com", "ü" * 70 + ".com", "x.y", "İstanbul.COM", "ΣΑΣ.gr", "­.com", "a​b.com",
          "a.com..", "a b.com", "x.xn--p1ai", "_a.com", "a.c1", "abcdefghi." * 30 + "com", "a." + "b" * 64, " BÜCHER.Example. ", "example.c1", "ｅｘａｍｐｌｅ。ｃｏｍ",
          "straße.de", "\tA.Com.\n", "a,b.com", "localhost", "x" * 100_000, "a.com\x00"]


def rows(spark, *cols):
    df = spark.createDataFrame(list(enumerate(VALUES)), "i int, v string")
    return [tuple(r) for r in df.select("i", *cols).orderBy("i").collect()]


def test_strict_policy(spark):
    for i, name, reason in rows(spark, nm.strict_name("v"), nm.strict_reason("v")):
        assert (name, reason) == (strict_name(VALUES[i]), strict_reason(VALUES[i])), VALUES[i]


def test_strict_struct(spark):
    v = {VALUES[i]: s for i, s in rows(spark, nm.strict_validate("v"))}
    assert tuple(v[" BÜCHER.Example. "]) == (True, "xn--bcher-kva.example", None)
    assert v["-a.com"].reason == "invalid_character" and v["a" * 64 + ".com"].reason == "label_too_long" and v["example.c1"].reason == "invalid_suffix"
    assert v[None].reason == "none" and v["a.com.."].reason == "empty_label"


def test_precheck(spark):
    got = {VALUES[i]: r for i, r in rows(spark, nm.precheck_reason("v"))}
    assert got[None] == "none" and got["."] == "empty" and got["a..b"] == "double_dot" and got["a.com.."] is None


def test_list_policy(spark):
    df = spark.createDataFrame([(x,) for x in ("﻿Example.COM", "a.xn--p1ai", "example.a1", "a." + "b" * 63, "a." + "b" * 25, "a." + "b" * 24, "a b.com", "", None)], "v string")
    n = nm.list_name("v")
    got = [tuple(r) for r in df.select(n.alias("n"), nm.list_valid(n, "lenient"), nm.list_valid(n, "balanced"), nm.list_valid(n, "strict")).collect()]
    assert got[0] == ("example.com", True, True, True)
    assert [g[1:] for g in got[1:]] == [(True, False, False), (True, False, False), (True, True, False), (True, True, False), (True, True, True), (False,) * 3, (False,) * 3, (False,) * 3]


def final(value):
    n = value.strip().lower().rstrip(".") if value is not None else ""
    if not n or any(c.isspace() or c == "," for c in n):
        return None
    try:
        n = n.encode("idna").decode("ascii")
    except UnicodeError:
        return None
    ok = all(x and len(x) < 64 and x[0] != "-" != x[-1] and all(c.isdigit() or "a" <= c <= "z" or c == "-" for c in x) for x in n.split("."))
    return n if ok and len(n) <= 253 else None


def test_final_policy(spark):
    for i, name in rows(spark, nm.final_name("v")):
        assert name == final(VALUES[i]), VALUES[i]


def test_small_functions(spark):
    df = spark.createDataFrame([(" Tarn Wick ", "a.b.com"), ("　", "localhost"), (None, None)], "k string, d string")
    assert [tuple(r) for r in df.select(nm.key_form("k"), nm.suffix("d"), nm.header_form("k")).collect()] == [("tarn wick", "com", "tarnwick"), (None, "", ""), (None, "", None)]
