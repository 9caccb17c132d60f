"""Employee data: profiles with the name of the manager."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyweave.functions import composite_key, is_linked, with_defaults
from keyweave.plans.customer import with_person
from keyweave.plans.items import item, same
from keyweave.plans.store import CONTACT, TEXT

PROFILE = ("FirstName", "LastName", "Title", "BirthDate", "HireDate", *CONTACT)


def employee_data(tables: dict[str, DataFrame], stamp: str) -> DataFrame:
    employee = with_defaults(
        tables["Employee"], {**dict.fromkeys(PROFILE, TEXT), "ReportsTo": ("bigint", None)}
    )
    rows = with_person(employee, tables, "ReportsTo", "__manager")
    managed = is_linked("ReportsTo")
    this = composite_key("EMPLOYEE", "EmployeeId")
    return item(
        rows,
        "EmployeeProfile",
        this,
        F.lit("PROFILE"),
        {
            **same("EmployeeId", *PROFILE),
            "ReportsTo": F.when(managed, F.col("ReportsTo")),
            "ManagerName": F.when(managed, F.col("__manager")),
        },
        stamp,
        index1=(F.when(managed, composite_key("MANAGER", "ReportsTo")), F.when(managed, this)),
    )
