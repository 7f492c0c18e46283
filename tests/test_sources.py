"""Loading, layers, exports, exploration, metrics and the stream split."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelflens.config import DATASETS, Dataset
from shelflens.functions.rules import is_valid
from shelflens.operators import explore
from shelflens.operators import inventory as inv
from shelflens.operators.metrics import all_metrics, metric_rows
from shelflens.sources import sinks
from shelflens.sources.readers import load_dataset, load_layer, missing_columns
from shelflens.sources.shared import scratch, shared_folder, write_once
from shelflens.streaming.quarantine import split_stream
from tests import seed
from tests.conftest import rows


def test_csv_with_declared_types(spark, tmp_path, caplog):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/products.csv").write_text(
        "extra,product_id,product_name,unit_price,max_restock_quantity\nx,P1,Milk,1.5,10\ny,NA,nan,oops,\n"
    )
    df = load_dataset(spark, "products", str(tmp_path))
    assert df.schema["unit_price"].dataType.simpleString() == "double"
    assert rows(df) == [("x", "P1", "Milk", 1.5, 10.0), ("y", None, None, None, None)]
    assert missing_columns(df, DATASETS["products"].required) == ["sku"]
    assert "sku" in caplog.text


def test_delimiter_encoding_and_formats(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("id;day\nGröße;2024-01-05\n".encode("latin-1"))
    frame = spark.createDataFrame([("1", 2.5)], "id string, v double")
    frame.write.parquet(str(tmp_path / "b"))
    frame.write.json(str(tmp_path / "c"))
    datasets = {
        "a": Dataset("a.txt", delimiter=";", encoding="ISO-8859-1", types={"day": "date"}),
        "b": Dataset("b", file_type="parquet"),
        "c": Dataset("c", file_type="json"),
        "d": Dataset("d", file_type="xml"),
        "e": Dataset("nowhere.csv"),
    }
    base = str(tmp_path)
    row = load_dataset(spark, "a", base, datasets).first()
    assert row["id"] == "Größe" and row["day"].isoformat() == "2024-01-05"
    assert rows(load_dataset(spark, "b", base, datasets)) == [("1", 2.5)]
    assert rows(load_dataset(spark, "c", base, datasets)) == [("1", 2.5)]
    with pytest.raises(ValueError, match="Unsupported file type"):
        load_dataset(spark, "d", base, datasets)
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, "e", base, datasets)
    with pytest.raises(ValueError, match="not found"):
        load_dataset(spark, "f", base, datasets)


def test_json_by_declared_columns(spark, tmp_path):
    lines = ['{"v": 2.0, "id": "1", "day": "2024-01-05"}', '{"id": 7, "note": "not declared"}', '{"v": "oops"}']
    (tmp_path / "a.json").write_text("\n".join(lines))
    dataset = Dataset("a.json", file_type="json", columns=("id", "v", "day"), types={"v": "long", "day": "date"})
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = load_dataset(spark, "a", str(tmp_path), {"a": dataset})
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert df.schema.simpleString() == "struct<id:string,v:bigint,day:date>"
    assert [(r["id"], r["v"], r["day"] and r["day"].isoformat()) for r in df.collect()] == [
        ("1", 2, "2024-01-05"),
        ("7", None, None),
        (None, None, None),
    ]


def test_line_breaks_in_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"a\nb"\n2,c\n')
    df = load_dataset(spark, "a", str(tmp_path), {"a": Dataset("a.csv", line_breaks=True)})
    assert rows(df) == [("1", "a\nb"), ("2", "c")]


def test_malformed_date_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("day\nsoon\n")
    df = load_dataset(spark, "a", str(tmp_path), {"a": Dataset("a.csv", types={"day": "date"})})
    with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID"):
        df.collect()


def test_layers_round_trip(spark, tmp_path):
    out = str(tmp_path)
    raw = seed.snapshots(spark)
    assert rows(sinks.archive_raw(raw, out, "snap")) == rows(raw)
    assert load_layer(spark, f"{out}/raw/snap_raw.parquet").count() == 30
    assert load_layer(spark, f"{out}/raw/other.parquet") is None

    lists = spark.createDataFrame([("a", ["x", "y"])], "id string, items array<string>")
    assert rows(sinks.write_curated(lists, out, "lists")) == [("a", ["x", "y"])]
    text = spark.read.csv(f"{out}/curated/lists/lists.csv", header=True, escape='"')
    assert rows(text) == [("a", '["x","y"]')]

    _, invalid = inv.validate_snapshot(raw, seed.products(spark))
    written = sinks.write_quarantine(inv.quarantine(invalid, "snap"), out, "snap")
    assert written.count() == 5 and "quarantine_date" in written.columns
    assert sinks.write_quarantine(invalid.limit(0), out, "none") is None
    assert load_layer(spark, f"{out}/quarantine/quarantine_none/quarantine_none.parquet") is None


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    table = write_once(spark.range(3), "numbers")
    assert table.inputFiles()[0].startswith(f"file://{shared_folder(spark)}/numbers-")


def test_scratch_tables_are_deleted(spark):
    with scratch(spark):
        table = write_once(spark.range(3), "gone")
        folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
        assert folder.is_dir()
    assert not folder.exists()


@pytest.fixture(scope="module")
def fact(spark):
    snapshot, _ = inv.validate_snapshot(seed.snapshots(spark), seed.products(spark))
    restock, _ = inv.validate_restock(seed.restocks(spark), seed.products(spark))
    return inv.inventory_fact(inv.reconcile(snapshot, restock), seed.products(spark), seed.stores(spark))


def test_exploration(spark, fact, tmp_path):
    totals = explore.inventory_totals(fact).first()
    assert (totals["records"], totals["mean_effective_stock"], totals["total_stock_movement"]) == (24, 353.125, 1120)
    by_store = dict(rows(explore.stock_by(fact, "store_name")))
    assert sum(by_store.values()) == 24 * 353.125 and set(by_store) == {"Store A", "Store B", "Store C"}
    counts = [tuple(r) for r in explore.value_counts(fact, "store_name").collect()]
    assert counts == [("Store A", 11), ("Store B", 8), ("Store C", 5)]
    assert rows(explore.choices(fact, "category")) == [("Dairy",), ("Grains",)]
    assert explore.filter_fact(fact).count() == 24
    chosen = explore.filter_fact(fact, store_name="Store A", category="Grains")
    assert {r["product_id"] for r in chosen.collect()} == {"PRD002", "PRD008"}
    sinks.write_csv(chosen, str(tmp_path / "view"))
    assert spark.read.csv(str(tmp_path / "view"), header=True).count() == chosen.count()
    layers = {"raw": seed.snapshots(spark), "curated": fact}
    assert rows(explore.layer_counts(layers)) == [("curated", 24), ("raw", 30)]


def test_metric_rows(spark):
    one = spark.createDataFrame([(1, 2.5)], "a int, b double")
    assert rows(metric_rows(one)) == [("a", 1.0), ("b", 2.5)]
    assert rows(all_metrics({"x": one, "y": one.select("a")})) == [("x.a", 1.0), ("x.b", 2.5), ("y.a", 1.0)]


def test_stream_is_split_like_the_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    restock, products = seed.restocks(spark), seed.products(spark)
    restock.repartition(3).write.parquet(str(source))
    stream = spark.readStream.schema(restock.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    writer = split_stream(
        stream, lambda batch: inv.tag_restock(batch, products), "restock_events", out, str(tmp_path / "checkpoint")
    )
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(120)
    tagged = inv.tag_restock(restock, products)
    staged = spark.read.parquet(f"{out}/staging/restock_events")
    assert rows(staged, "restock_id") == rows(tagged.filter(is_valid()), "restock_id")
    assert staged.select("batch").distinct().count() == 3
    bad = spark.read.parquet(f"{out}/quarantine/restock_events")
    assert bad.count() == 6 and bad.filter(F.col("error_type") == "EXCEEDED_LIMIT").count() == 3
