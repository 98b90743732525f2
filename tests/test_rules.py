from datetime import date

from pyspark.sql import functions as F

from cribble.functions import rules as ru
from cribble.operators import scorers


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_reasons(spark):
    assert one(spark, ru.reason_code(F.lit("a: b: c")), ru.decision_reason(F.lit("a"), F.lit("b")), ru.decision_reason(F.lit("a"), F.lit("b"), F.lit("2")), ru.decision_reason(F.lit(None).cast("string"), F.lit("b"))) == ("a", "a: b", "a: b | 한국 관련성: 2", None)
    assert one(spark, ru.relevance_gate(F.lit(0), F.lit(4)), ru.relevance_gate(F.lit(1), F.lit(0)), ru.relevance_gate(F.lit(1), F.lit(1)), ru.relevance_gate(F.lit(None).cast("int"), F.lit(1))) == ("taxonomy_mismatch", "low_korea_relevance", None, "taxonomy_mismatch")
    assert one(spark, ru.better_type(F.lit("x"), F.lit(3), F.array(F.lit("x"))), ru.better_type(F.lit("x"), F.lit(2), F.array(F.lit("x"))), ru.better_type(F.lit("y"), F.lit(4), F.array(F.lit("x")))) == ("x", None, None)


def test_terms(spark):
    arr = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    none = F.lit(None).cast("array<string>")
    assert one(spark, *ru.merged_terms(arr("a", "b"), arr("b", "c"), arr("d"), arr("g"))) == (["a", "b", "c"], "static_and_fresh")
    assert one(spark, *ru.merged_terms(none, arr("c"), none, none)) == (["c"], "fresh_only")
    assert one(spark, *ru.merged_terms(arr(), none, arr("d"), arr("g"))) == (["d"], "definition_fallback")
    assert one(spark, *ru.merged_terms(none, none, none, none)) == ([], "lv2_fallback")
    assert one(spark, ru.definition_terms(F.lit("신상털기, 비방·모욕 등 행위 및 /협박.")), ru.without_citations(arr("말 [1]", "글"))) == (["신상털기", "비방", "모욕", "행위", "협박"], ["말 [1]", "글"])


def test_dates_and_texts(spark):
    assert one(spark, ru.months_back(F.lit(date(2025, 3, 31)), 1), *ru.default_range(date(2024, 2, 29), 1)) == (date(2025, 2, 28), date(2023, 2, 28), date(2024, 2, 29))
    ab = F.array(F.lit("a"), F.lit("b"))
    assert one(spark, ru.site_query(ab, F.lit("q")), ru.bullet_list(ab), ru.excluded_domains(F.array(F.lit("c")), ab)) == ("(site:a OR site:b) q", "- a\n- b", ["a", "b", "c"])
    assert one(spark, ru.request_digest(F.lit(1).alias("x"))) == one(spark, ru.request_digest(F.lit(1).alias("x")))


def test_scorer_survives_errors(spark):
    df = spark.createDataFrame([(1, "한글 본문"), (2, None), (3, "x")], "id long, content string")

    def fails(row):
        if row["id"] == 3:
            raise ValueError
        return scorers.stub(row)

    got = {r.id: r.overall for r in scorers.score(df, ["id"], fails).collect()}
    assert got[1] is not None and (got[3] is None or got[3] != got[3])
