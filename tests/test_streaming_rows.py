"""Row-wise cleaning and scoring hold no state, so a stream can use them."""

from panelrisk import settings
from panelrisk.functions.columns import level_of, weighted_index
from panelrisk.operators.cleaning import clip_rates, coerce_numeric


def test_row_operators_on_a_stream(spark, tmp_path):
    rows = [("2010", "120", "30"), ("2011", "x", "10")]
    spark.createDataFrame(rows, "ano string, taxa_a string, tdi_b string").write.parquet(
        str(tmp_path / "in"))
    stream = spark.readStream.schema("ano string, taxa_a string, tdi_b string").parquet(
        str(tmp_path / "in"))
    out = clip_rates(coerce_numeric(stream, ["ano"]))
    out = out.withColumn("i", weighted_index({"taxa_a": 0.5, "tdi_b": 0.5}, out.columns, 1))
    out = out.withColumn("n", level_of("i", settings.SCORE_CUTS, settings.SCORE_LABELS))
    query = (out.writeStream.format("memory").queryName("row_ops")
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.processAllAvailable()
    query.stop()
    got = sorted((r["ano"], r["i"], r["n"]) for r in spark.table("row_ops").collect())
    assert got == [("2010", 65.0, "Critico"), ("2011", 10.0, "Baixo")]
