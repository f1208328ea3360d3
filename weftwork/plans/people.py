"""Staff questions: best pay, hires in a range, pay by department, who never managed, current titles.

The star of five or six tables is joined fact side first; what can be reduced is reduced before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.operators.aggregate import latest_row


def best_pay(people: DataFrame, pay: DataFrame, key: str, amount: str, name: str = "max_amount") -> DataFrame:
    """Everyone who was paid, with their highest pay."""
    return people.join(pay.groupBy(key).agg(F.max(amount).alias(name)), key)


def hired_between(people: DataFrame, date: str, after: str, before: str) -> DataFrame:
    return people.where((F.col(date) > after) & (F.col(date) < before))


def never_in(people: DataFrame, others: DataFrame, key: str) -> DataFrame:
    return people.join(others, key, "left_anti")


def top_paid_titles(
    pay: DataFrame, titles: DataFrame, key: str, amount: str, title: list[str], order: list[str], k: int = 10
) -> DataFrame:
    """The current title of the ``k`` best paid. Titles of others are dropped before they are ranked."""
    best = pay.groupBy(key).agg(F.max(amount).alias("max_amount")).orderBy(F.desc("max_amount"), key).limit(k)
    theirs = titles.join(F.broadcast(best), key).groupBy(key, "max_amount")
    last = F.max_by(F.struct(*title), F.struct(*order)).alias("last")
    return theirs.agg(last).select(key, "max_amount", "last.*")


def current_titles(titles: DataFrame, key: str, title: list[str], order: list[str]) -> DataFrame:
    return latest_row(titles, [key], title, order)


def pay_by_department(
    hires: DataFrame, memberships: DataFrame, pay: DataFrame, after: str, before: str, scale: int | None = None
) -> DataFrame:
    """Mean pay by department of those hired in a range.

    Written as a comma list with WHERE over (key, hired), (key, department) and (key, amount). Amounts are added in their own
    type, or as decimals of ``scale`` places.
    """
    amount = "p.amount" if scale is None else f"CAST(p.amount AS DECIMAL(28, {int(scale)}))"
    return hires.sparkSession.sql(
        f"""
        SELECT m.department, CAST(sum({amount}) AS DOUBLE) / count(p.amount) AS mean_amount
        FROM {{hires}} h, {{memberships}} m, {{pay}} p
        WHERE h.key = m.key AND h.key = p.key AND h.hired > :after AND h.hired < :before
        GROUP BY m.department""",
        args={"after": after, "before": before}, hires=hires, memberships=memberships, pay=pay,
    )


def best_department(by_department: DataFrame, departments: DataFrame) -> DataFrame:
    """Name and mean pay of the best-paying department; ``departments`` has (department, name)."""
    best = by_department.orderBy(F.desc("mean_amount"), "department").limit(1)
    return departments.join(F.broadcast(best), "department").select("name", "mean_amount")
