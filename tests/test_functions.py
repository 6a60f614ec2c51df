from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siftworks.functions import dates as D
from siftworks.functions import text as T
from siftworks.functions import vocabulary as V


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def test_strip_and_squash_know_unicode_spaces(spark):
    assert one(spark, T.strip(F.col("a")), a="\xa0\t a b \n") == "a b"
    assert one(spark, T.squash(F.col("a")), a=" a \n\t b\xa0c ") == "a b c"
    assert one(spark, T.squash(F.col("a")), a=None) == ""


def test_squash_twice_is_once(spark):
    rows = spark.createDataFrame([(s,) for s in ("", " a  b ", "\xa0x\x1cy\n")], "a string")
    assert rows.where(T.squash(T.squash(F.col("a"))) != T.squash(F.col("a"))).count() == 0


def test_html_to_text(spark):
    cases = {
        "<p>a<br>b</p>": "a\nb",
        "<ul><li>one<li>two</ul>": "- one\n- two",
        "&lt;p&gt;x &amp;amp; y&lt;/p&gt;": "x & y",
        "a&nbsp;b": "a b",
        "<div>a</div><div></div><div></div><div>b</div>": "a\n\nb",
        "": "",
        "<script>var t = '</p>'</script>z": "var t = '</p>'z",
    }
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "raw string, want string")
    assert [tuple(r) for r in rows.select("want", T.html_to_text("raw").alias("got")).where("want <> got").collect()] == []


def test_strip_markup_leaves_plain_texts(spark):
    assert one(spark, T.strip_markup(F.col("a")), a=" a < b and <5 ms ") == "a < b and <5 ms"
    assert one(spark, T.strip_markup(F.col("a")), a="<b>x</b>") == "x"


def test_ids(spark):
    assert one(spark, T.stable_id(F.lit("x"), F.col("a"), F.col("b")), a="Crédit Agricole", b="a:b") == "x:credit-agricole:a:b"
    assert one(spark, T.stable_id(F.lit("x"), F.col("a"), F.col("b")), a="", b="7") == "x:_:7"
    assert one(spark, T.split_stable_id(F.col("a")), a="x:y:a:b") == ["x", "y", "a:b"]


def test_tags_equal_the_bounded_expressions(spark):
    """The token cut and the expressions agree row by row."""
    texts = ["python3x kafka", "c++ c+++ c#", "Go go GO2", "x_sql sql2 sql", "node.js nodejs Node", "", "3python k8s9", "REST rest", "ci/cd, no-sql"]
    rows = spark.createDataFrame([(t,) for t in texts], "a string")
    slow = F.filter(F.array(*[F.when(F.lit(False) if not ts else _any(ts), F.lit(n)) for n, ts in sorted(V.TECHNOLOGIES.items(), key=lambda x: x[0].lower())]), lambda x: x.isNotNull())
    bad = rows.select("a", V.tag(F.col("a")).alias("fast"), slow.alias("slow")).where("fast <> slow").collect()
    assert bad == []


def _any(terms):
    out = F.lit(False)
    for t in terms:
        out = out | F.col("a").rlike(V.term_pattern(t))
    return out


def test_vocabulary_index():
    assert V.canonical(["K8S", " python ", "zig", ""]) == ["Kubernetes", "Python", "zig"]
    assert V.extended(["Zig", "zig", "python"])["Zig"] == ("zig",)
    assert "zig" not in V.extended(["Zig", "zig"])


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/St_Johns"])
def test_dates_are_utc_in_any_session(spark, zone):
    """Also within the hours that a clock skips or repeats in spring and autumn."""
    cases = {
        "2026-09-05T10:20:30Z": "2026-09-05T10:20:30+00:00",
        "2026-09-05T12:20:30+02:00": "2026-09-05T10:20:30+00:00",
        "2026-09-05T12:20:30+0200": "2026-09-05T10:20:30+00:00",
        "2026-09-05T10:20:30.999999": "2026-09-05T10:20:30+00:00",
        "2026-09-05 10:20:30": "2026-09-05T10:20:30+00:00",
        "2026-09-05": "2026-09-05T00:00:00+00:00",
        "20260905": "2026-09-05T00:00:00+00:00",
        "Sat, 05 Sep 2026 10:20:30 GMT": "2026-09-05T10:20:30+00:00",
        "5 Sep 2026 10:20:30": "2026-09-05T10:20:30+00:00",
        "5 Sep 2026 10:20:30 -0230": "2026-09-05T12:50:30+00:00",
        "1788603630": "2026-09-05T10:20:30+00:00",
        "1788603630000": "2026-09-05T10:20:30+00:00",
        "2026-03-29T02:30:00": "2026-03-29T02:30:00+00:00",
        "2026-03-29T00:30:00Z": "2026-03-29T00:30:00+00:00",
        "2026-10-25T00:30:00Z": "2026-10-25T00:30:00+00:00",
        "2026-10-25T01:30:00Z": "2026-10-25T01:30:00+00:00",
        "2026-03-08T02:15:00": "2026-03-08T02:15:00+00:00",
        "2026": "",
        "soon": "",
        "2026-13-40": "",
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = spark.createDataFrame([(k,) for k in cases], "raw string")
        got = {r["raw"]: r["iso"] for r in rows.select("raw", D.to_iso_utc(F.col("raw")).alias("iso")).collect()}
        assert got == cases
        wall = spark.sql("SELECT TIMESTAMP_NTZ'2026-03-29 02:30:00' AS t, TIMESTAMP'2026-03-29 12:00:00Z' AS z, DATE'2026-01-02' AS d")
        shown = wall.select(D.iso(F.col("t")).alias("t"), D.iso(F.col("z")).alias("z"), D.iso(F.col("d")).alias("d"), D.day_of(F.lit("2026-09-14T23:30:00-03:00")).alias("day")).first()
        assert tuple(shown) == ("2026-03-29T02:30:00+00:00", "2026-03-29T12:00:00+00:00", "2026-01-02T00:00:00+00:00", "2026-09-14")
        assert rows.select(F.unix_seconds(D.instant(F.lit("2026-03-29T02:30:00")))).first()[0] == 1774751400
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_accents_fold_as_unicode_decomposes(spark):
    """Every character, alone and in a text; no Python in the plan."""
    import unicodedata

    chars = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c > 0xF000 and c < 0x20000)]
    texts = ["".join(chars[i : i + 500]) for i in range(0, len(chars), 500)] + ["ño Café ½ ﬁn ㎏ Łódź ß", "plain ASCII -- x", "", None, "Ａ１ ｅ́"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    folded = rows.select("i", T.folded_ascii(F.col("t")).alias("f"), T.slug(F.col("t")).alias("s"))
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = {r["i"]: r for r in folded.collect()}
    for i, t in enumerate(texts):
        want = unicodedata.normalize("NFKD", t or "").encode("ascii", "ignore").decode()
        assert got[i]["f"] == want, t
    assert got[len(texts) - 5]["s"] == "no-cafe-12-fin-kg-odz"
