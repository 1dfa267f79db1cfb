"""S4-S6: the three-column results as numbered text lines.

The original client reads three positional columns as strings and prints one
line per row, prefixed by the row's ordinal. Here the lines are built by
``concat`` on the executors and written with ``write.text``; nothing is
gathered on the driver.

* S4 :func:`as_strings` - project three columns, each cast to string (a null
  prints as ``null``, as string concatenation in the original does);
* S5 numbering - :mod:`stockyard.plans.numbering`;
* S6 :func:`render` - ``{n} {label1}{v1} {label2}{v2} {label3}{v3}``.

Doubles are rendered through ``decimal(18,4)`` so the text does not depend on
how a double prints; U1 renders its exact decimal sum directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import cross_territory, ranking, sales
from ..plans.numbering import number, number_rows
from ..plans.scratch import Scratch
from ..sources.tables import Tables

# The report line labels, exactly as the original client prints
# them (including the misspelt "TeritorioPedido").
SALES_LABELS = ("Total Ventas:", "Territorio:", "IDTerritorio:")
PRODUCT_LABELS = ("Producto:", "Solicitudes:", "Region:")
CROSS_TERRITORY_LABELS = ("ID: ", "TeritorioPedido:", "TerritorioMandado:")

MONEY_TEXT = "decimal(38,4)"  # as wide as the exact sum


def as_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def as_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    """S4: the three result columns, as strings, named v1..v3."""
    if len(columns) != 3:
        raise ValueError("a report row has exactly three columns")
    return df.select(*[as_text(F.col(c)).alias(f"v{i}") for i, c in enumerate(columns, 1)])


def render(numbered: DataFrame, labels: tuple[str, str, str], n: str = "n") -> DataFrame:
    """S6: n bigint, line string, from columns v1..v3 and the ordinal ``n``."""
    parts: list[Column] = [F.col(n).cast("string")]
    for i, label in enumerate(labels, 1):
        parts += [F.lit(" " + label), F.col(f"v{i}")]
    return numbered.select(F.col(n), F.concat(*parts).alias("line"))


def sales_report(t: Tables, category: int, scratch: Scratch | None = None) -> DataFrame:
    """U1 as lines, numbered by territory_id. At most one row per territory: if that
    dimension has passed its size check, in one window task, else distributed."""
    exact = sales.sales_by_territory_exact(t, category).withColumn(
        "total_sales", F.col("total_sales").cast(MONEY_TEXT)
    )
    strings = exact.select(
        "territory_id", *[as_text(F.col(c)).alias(c) for c in ("total_sales", "territory")]
    ).select(
        "territory_id",
        F.col("total_sales").alias("v1"),
        F.col("territory").alias("v2"),
        as_text(F.col("territory_id")).alias("v3"),
    )
    bounded = t.bounded_cache.get("territory", False)
    return render(number(strings, ["territory_id"], bounded, scratch=scratch), SALES_LABELS)


def top_product_report(t: Tables, scratch: Scratch | None = None, **kwargs) -> DataFrame:
    """U2 as lines, numbered by (region, product_id); distributed, since the
    number of tied winners is not bounded."""
    top = ranking.top_requested_product(t, **kwargs)
    numbered = number_rows(top, ["region", "product_id"], scratch=scratch)
    strings = numbered.select(
        "n",
        as_text(F.col("product")).alias("v1"),
        as_text(F.col("requests")).alias("v2"),
        as_text(F.col("region")).alias("v3"),
    )
    return render(strings, PRODUCT_LABELS)


def cross_territory_report(t: Tables, grain: str = "customer", scratch: Scratch | None = None) -> DataFrame:
    """U4 as lines, numbered by (id, order_territory, ship_territory), distributed."""
    rows = cross_territory.cross_territory(t, grain)
    numbered = number_rows(rows, ["id", "order_territory", "ship_territory"], scratch=scratch)
    strings = numbered.select(
        "n",
        as_text(F.col("id")).alias("v1"),
        as_text(F.col("order_territory")).alias("v2"),
        as_text(F.col("ship_territory")).alias("v3"),
    )
    return render(strings, CROSS_TERRITORY_LABELS)


def write_report(lines: DataFrame, path: str, mode: str = "errorifexists", scratch: Scratch | None = None) -> None:
    """Emit the lines as text files, in ordinal order within and across files: the
    numbering leaves its partitions in that order, so nothing is sorted again. What the report kept in ``scratch`` is removed."""
    lines.select("line").write.mode(mode).text(path)
    if scratch is not None:
        scratch.release()
