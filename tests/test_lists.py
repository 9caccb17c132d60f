"""Items without their lists: the same rows from fewer columns."""

from keyweave.plans.customer import customer_data, invoice_items
from tests.store_data import SAMPLE, generated


def test_the_same_items_but_for_the_lists(spark, rows):
    tables = generated(spark, **SAMPLE)
    whole = invoice_items(tables, "now", page_size=1)
    bare = invoice_items(tables, "now", page_size=1, lists=False)
    assert set(whole.columns) - set(bare.columns) == {"InvoiceLines"}
    assert rows(bare) == rows(whole, *bare.columns)


def test_keys_read_only_the_link_of_the_lines(spark, tmp_path):
    tables = dict(generated(spark, **SAMPLE))
    tables["InvoiceLine"].write.parquet(str(tmp_path / "lines"))
    tables["InvoiceLine"] = spark.read.parquet(str(tmp_path / "lines"))
    plan = customer_data(tables, "now", lists=False).select("PK", "SK")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<InvoiceId:" in plan and "TrackId" not in plan


def test_an_invoice_counts_once_however_many_pages(spark):
    tables = generated(spark, **SAMPLE)
    items = invoice_items(tables, "now", page_size=1)
    total = tables["Invoice"].agg({"Total": "sum"}).first()[0]
    assert items.filter("Page IS NOT NULL").count() > 0
    assert abs(items.agg({"Total": "sum"}).first()[0] - total) < 1e-9
    assert items.filter("Page IS NOT NULL AND (Total IS NOT NULL OR BillingCity IS NOT NULL)").count() == 0
