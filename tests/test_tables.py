import pytest
from pyspark.sql import functions as F

from gradeloom.operators import dedupe, dimension, pages, ranking, updates


def test_first_last_and_duplicates(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 1, "z"), (None, 1, "n"), (None, 2, "m")], "k string, o int, v string")
    assert sorted((r.k or "", r.v) for r in dedupe.keep_first(df, ["k"], ["o"]).collect()) == [("", "n"), ("a", None), ("b", "z")]
    assert sorted((r.k or "", r.v) for r in dedupe.keep_last(df, ["k"], ["o"]).collect()) == [("", "m"), ("a", "x"), ("b", "z")]
    assert [(r.k, r.n) for r in dedupe.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    assert dedupe.duplicate_rows(df, ["k"]).count() == 2


def test_ranks(spark):
    averages = spark.createDataFrame(
        [(1, f"s{i:02d}", 7 + (i % 5) / 1000 + i % 3) for i in range(40)] + [(2, "x", 10.0), (2, "a", 10.0)], "an int, id string, medie double"
    )
    got = {(r.an, r.id): r["rank"] for r in ranking.rank_by_average(averages).collect()}
    for year in (1, 2):
        rows = sorted((-r.medie, r.id) for r in averages.collect() if r.an == year)
        assert [got[year, i] for _, i in rows] == list(range(1, len(rows) + 1))
    schools = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    middle = spark.createDataFrame([("a", 5), ("b", 6)], "id string, rank int")
    high = spark.createDataFrame([("b", 1)], "id string, rank int")
    assert sorted(map(tuple, ranking.combined_rank(schools, middle, high).collect())) == [("a", 5), ("b", 1), ("c", 1_000_000)]


def test_update_modes(spark):
    base = spark.createDataFrame([(1, "k1", "a", "b"), (1, "k2", "c", "d"), (1, "k3", "e", "f")], "an int, k string, x string, y string")
    batch = spark.createDataFrame([(1, "k1", None, None), (1, "k2", "n", None), (1, "k9", "m", None)], "an int, k string, x string, y string")

    def run(mode):
        return sorted(tuple(r) for r in updates.update_by_key(base, batch, ["an", "k"], mode).collect())

    assert run("column") == [(1, "k1", None, "b"), (1, "k2", "n", "d"), (1, "k3", "e", "f")]
    assert run("cell") == [(1, "k1", "a", "b"), (1, "k2", "n", "d"), (1, "k3", "e", "f")]
    assert run("row") == [(1, "k1", None, None), (1, "k2", "n", None), (1, "k3", "e", "f")]
    once = updates.update_by_key(base, batch, ["an", "k"])
    assert sorted(map(tuple, updates.update_by_key(once, batch, ["an", "k"]).collect())) == run("column")
    with pytest.raises(updates.DuplicateKeyError):
        updates.update_by_key(base, batch.union(batch), ["an", "k"])
    assert [r.k for r in updates.unknown_keys(base, batch, ["an", "k"]).collect()] == ["k9"]


def test_upsert(spark):
    base = spark.createDataFrame([("a", "1", "p")], "k string, x string, y string")
    batch = spark.createDataFrame([("a", "2", "q"), ("b", "3", "r")], "k string, x string, y string")
    rows = sorted(map(tuple, updates.upsert_by_key(base, batch, ["k"], ["x"]).collect()))
    assert rows == [("a", "2", "p", False), ("b", "3", "r", True)]


def test_aliases(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(9)] + [("m", "n4"), ("s", "s")], "alternativ string, corect string")
    resolved = {r.alternativ: r.corect for r in dimension.resolve_aliases(chain).collect()}
    assert set(resolved.values()) == {"n9"} and len(resolved) == 10
    for cycle in ([("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a")]):
        with pytest.raises(dimension.AliasCycleError):
            dimension.resolve_aliases(spark.createDataFrame(cycle, "alternativ string, corect string"))


def test_unused_schools_keep_null_codes(spark):
    schools = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "id string, cod_siiir string")
    codes = spark.createDataFrame([("1",), (None,)], "unitate_siiir string")
    assert sorted(r.id for r in dimension.drop_unused_schools(schools, codes).collect()) == ["a", "c"]


def test_two_line_record_reorder(values, spark):
    df = spark.createDataFrame([(19, 10), (21, 10)], "a int, b int")
    one = F.transform(F.sequence(F.lit(0), F.col("a") - 1), lambda i: F.concat(F.lit(" a"), i.cast("string"), F.lit("\nx")))
    two = F.transform(F.sequence(F.lit(0), F.col("b") - 1), lambda i: F.concat(F.lit("b"), i.cast("string")))
    for row, extra in zip(df.select(pages.reorder_two_lines(one, two).alias("c")).collect(), (0, 2)):
        a, b = [f"a{i}" for i in range(19 + extra)], [f"b{i}" for i in range(10)]
        p = extra
        spans = (a[0:2], a[p + 2:p + 12], b[0:4], a[p + 12:p + 15], b[4:7], [a[p + 15]], b[7:10], a[p + 16:p + 19])
        # the first cell of a span keeps its lines, the others their first one
        assert row.c == [cell + ("\nx" if n == 0 and cell[0] == "a" else "") for s in spans for n, cell in enumerate(s)]


def test_character_references(values):
    texts = ["&#259; &#x219;&#X21B; &icirc;&Acirc; &abreve;", "&amp;lt; &amp;#259; &lt;b&gt;", "a & b &; &bogus; &#xZ; &#0; &#55296; &#1114112;", "&#128512;", "", None, "no reference", "x&nbsp;y&quot;&apos;"]
    wanted = ["ă șț îÂ ă", "&lt; &#259; <b>", "a & b &; &bogus; &#xZ; \ufffd \ufffd \ufffd", "\U0001f600", "", None, "no reference", "x y\"'"]
    assert values(lambda a: pages.decoded(F.col(a)), texts) == wanted


PAGE = """<html><!-- <tr class="tr1"><td>no</td></tr> --><input type=hidden name="__VIEWSTATE" value="a&b"/>
<tr class='x tr1'><td> 1 </td><td>A <b>B</b><br/>C &amp; &lt;D&gt;</td><td></td></tr><tr class="tr10"><td>z</td></tr>
<tr class="tr2"><td>2<!-- c --><script>var a="<td>";</script></td></tr><p>pag. 3 pag. 12 pag. 7</p></html>"""


def test_page_rows(spark):
    df = spark.createDataFrame([(1, PAGE.replace('<!-- <tr class="tr1"><td>no</td></tr> -->', "")), (2, "Eroare " + PAGE), (3, "<p/>")], "page_id int, html string")
    rows = pages.page_rows(df, separator="<br/>").orderBy("row_no").collect()
    assert [(r.page_id, r.row_no, r.cells) for r in rows] == [(1, 0, ["1", "A<br/>B<br/>C & <D>", ""]), (1, 1, ["2"])]
    joined = pages.page_rows(df, two_lines=True).collect()
    assert [r.cells for r in joined] == [["1", "ABC & <D>", "", "2"]]
    first = df.filter("page_id = 1")
    assert tuple(first.select(pages.page_count("html"), pages.page_count("html", last=True)).first()) == (12, 7)
    assert first.select(pages.hidden_fields("html")).first()[0] == {"__VIEWSTATE": "a&b"}
    assert first.select(pages.has_form_fields("html")).first()[0] is False
    assert first.select(pages.has_form_fields("html", ["__VIEWSTATE"])).first()[0] is True


def test_page_audit_without_sets(spark):
    rows = spark.createDataFrame([(1, 0, "1"), (1, 1, "2"), (2, 0, "4"), (2, 1, "5"), (3, 0, "5")], "page_no int, row_no int, crt string")
    audit = {r.page_no: (r.wrong_first, r.wrong_size, r.refetch) for r in pages.page_audit(rows, ["page_no"], "crt", 2).collect()}
    assert audit == {1: (False, False, False), 2: (True, False, True), 3: (False, False, False)}
    short = {r.page_no: r.wrong_size for r in pages.page_audit(rows, ["page_no"], "crt", 3).collect()}
    assert short == {1: True, 2: True, 3: False}


def test_files(spark):
    schools = spark.createDataFrame([("S_1_AB",), ("S",), ("T",)], "id string")
    files = spark.createDataFrame([("S_1_AB_2.png",), ("S_1_AB.ico.bak",), ("S_1.gif",), ("T.txt",)], "file_name string")
    found = {r.id: (r.sigla, r.sigla_xs) for r in dimension.attach_files(schools, files, files.filter("file_name like 'S_1.%'")).collect()}
    assert found == {"S_1_AB": ("S_1_AB.ico.bak", False), "S": ("S_1.gif", True), "T": (None, False)}
    assert [(r.id, r.n) for r in dimension.schools_with_many_files(schools, files).collect()] == [("S_1_AB", 2)]


def test_grow_dimension_insert_only(spark):
    schools = spark.createDataFrame([("a", "A", None, None)], "id string, nume string, gimnaziu boolean, last_updated bigint")
    batch = spark.createDataFrame([("a", "X", "1", 1), ("b", "SCOALA B", "2", 2), ("b", "SCOALA C", "2", 3)], "id string, nume string, cod_siiir string, o int")
    rows = {r.id: r for r in dimension.grow_dimension(schools, batch, ["o"], insert_only=True).collect()}
    assert rows["a"].nume == "A" and rows["b"].nume == "Scoala B" and rows["b"].gimnaziu and rows["b"].last_updated > 1_600_000_000_000
