import duckdb
import pytest
from ledgerwright.llm.queries import oracle_sql, queries

TABLES = ("documents", "embeddings", "pages", "labels")


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(rows):
    return sorted([tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows], key=str)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_sql(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    columns = sorted(df.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    want = duck.sql(f"SELECT {listed} FROM ({oracle_sql()[name]})").fetchall()
    assert normal([tuple(r) for r in df.select(*columns).collect()]) == normal(want)


def test_language_query(spark, sf):
    out = queries()["op5_language_id"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.count() == docs.count()
    right = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").selectExpr("avg(cast(lang = lang_pred AS double))").first()[0]
    assert right > 0.9


def test_quality_classifier_query(spark, sf):
    out = queries()["op10_quality_classifier"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = out.join(labels, "doc_id").where("quality = 1 AND toxic = 0")
    assert good.where("kept").count() > 0.9 * good.count()


@pytest.mark.parametrize("name", ["op2_sentencepiece", "op6_license_scans"])
def test_others_return_a_row_for_each_document(spark, sf, name):
    out = queries()[name](spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    if name == "op2_sentencepiece":
        assert out.where("NOT round_trip").count() == 0


def test_licence_query_inherits(spark, tmp_path):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    docs = [(1, f"short\n{mit}", "s0", "en"), (2, "prose", "s0", "en"), (3, "prose", "s0", "de"), (4, f"{gpl}\n" + "long " * 40, "s0", "en"),
            (5, f"{gpl}\nab", "s1", "en"), (6, "prose", "s1", "en"), (7, None, "s1", "en"), (8, "", "s1", "fr"), (9, gpl, "s0", "en"), (10, "prose", None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: r for r in queries()["op6_license_scans"](spark, str(tmp_path)).collect()}
    own = {i: name for i, t, *_ in docs for name, notice in (("MIT", mit), ("GPL-3.0", gpl)) if notice in (t or "").split("\n")}
    where = {i: f"{s or '-'}/{lang or '-'}" for i, _, s, lang in docs}
    for i, *_ in docs:
        # of the licence files of s0/en (1 and 9) both are exact; the lower similarity or else the later name loses
        best = min([(-out[k]["similarity"], out[k]["path"], own[k]) for k in (1, 5, 9) if where[k] == where[i]], default=None)
        want = (own[i], own[i], out[i]["path"]) if i in own else (None, best[2], where[i]) if best else (None, None, None)
        assert (out[i]["own_license"], out[i]["license"], out[i]["license_from"]) == want
    assert {i for i, r in out.items() if "/LICENSE." in r["path"]} == {1, 5, 9}
    assert {i for i, r in out.items() if r["license"] and not r["own_license"]} == {2, 6, 7}
