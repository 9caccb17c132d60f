"""Customer data: profiles with their support representative, invoices with embedded lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.functions import composite_key, full_name, is_linked, number, with_defaults
from keyweave.operators.embed import PAGE_SIZE, embed
from keyweave.operators.joins import lookup
from keyweave.operators.union import union_entities
from keyweave.plans.items import item, same
from keyweave.plans.store import CONTACT, TEXT

BILLING = ("BillingAddress", "BillingCity", "BillingState", "BillingCountry", "BillingPostalCode")


def customer_items(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    names = ("FirstName", "LastName", "Company", *CONTACT)
    customer = with_defaults(
        tables["Customer"], {**dict.fromkeys(names, TEXT), "SupportRepId": ("bigint", None)}
    )
    rows = with_person(customer, tables, "SupportRepId", "__rep")
    linked = is_linked("SupportRepId")
    this = composite_key("CUSTOMER", "CustomerId")
    return item(
        rows,
        "CustomerProfile",
        this,
        F.lit("PROFILE"),
        {
            **same("CustomerId", *names),
            "SupportRepId": F.when(linked, F.col("SupportRepId")),
            "SupportRepName": F.when(linked, F.col("__rep")),
        },
        stamp,
        index1=(F.lower(F.coalesce("Email", F.lit(""))), this),
        index2=(F.when(linked, composite_key("SUPPORT_REP", "SupportRepId")), F.when(linked, this)),
    )


def with_person(rows: DataFrame, tables: dict[str, DataFrame], link: str, into: str) -> DataFrame:
    """Name of the employee behind an optional link; empty when there is no such employee."""
    if "Employee" not in tables:
        return rows.withColumn(into, F.lit(""))
    employee = with_defaults(tables["Employee"], {"FirstName": TEXT, "LastName": TEXT})
    people = employee.select("EmployeeId", full_name("FirstName", "LastName").alias("__name"))
    found = lookup(rows, people, link, "EmployeeId", {into: "__name"}, "__person_found", optional=True)
    return found.withColumn(into, F.coalesce(into, F.lit(""))).drop("__person_found")


def invoice_items(tables: dict[str, DataFrame], stamp: str, page_size: int = PAGE_SIZE, lists: bool = True) -> DataFrame:
    """One item per invoice with all its lines. Without ``lists`` the items are the same but for their lines.

    Only an invoice of more than ``page_size`` lines has further items (``InvoicePage``) that hold
    the rest of the lines under sort keys right behind the invoice's own. What belongs to the invoice as
    a whole (total, billing address) stands in its first item only, so sums over all items are right.
    """
    invoice = with_defaults(
        tables["Invoice"], {**dict.fromkeys(("InvoiceDate", *BILLING), TEXT), "Total": ("double", 0.0)}
    )
    price = number("UnitPrice")
    rows = embed(
        invoice,
        "InvoiceId",
        tables["InvoiceLine"],
        "InvoiceId",
        {
            "InvoiceLineId": F.col("InvoiceLineId"),
            "TrackId": F.col("TrackId"),
            "UnitPrice": price,
            "Quantity": F.col("Quantity"),
            "LineTotal": price * F.col("Quantity"),
        },
        into="InvoiceLines",
        count="LineCount",
        page_size=page_size,
        lists=lists,
    )
    further = F.col("__page") > 0
    page_key = F.concat(F.lit("#PAGE#"), F.lpad(F.col("__page").cast("string"), 12, "0"))
    items = item(
        rows,
        "Invoice",
        composite_key("CUSTOMER", "CustomerId"),
        F.concat(composite_key("INVOICE", "InvoiceId"), F.when(further, page_key).otherwise(F.lit(""))),
        {
            **same("InvoiceId", "CustomerId", "InvoiceDate"),
            **{c: F.when(~further, F.col(c)) for c in BILLING},
            "Total": F.when(~further, number("Total")),
            **same(*(["InvoiceLines"] if lists else []), "LineCount"),
            "Page": F.when(further, F.col("__page")),
        },
        stamp,
    )
    return items.withColumn(
        "EntityType", F.when(F.col("Page").isNotNull(), "InvoicePage").otherwise(F.col("EntityType"))
    )


def customer_data(tables: dict[str, DataFrame], stamp: str, lists: bool = True) -> DataFrame:
    return union_entities([customer_items(tables, stamp), invoice_items(tables, stamp, lists=lists)])
