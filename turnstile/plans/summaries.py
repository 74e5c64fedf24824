"""Reports kept up to date by partial sums.

The sums of the fact by day and channel are stored beside it, cut by date as the
fact is. When the fact changes, the slices that the change has touched are totalled
anew and replace their old sums, which so takes back what replaced or moved rows had
brought; all other slices are neither read nor written. Reports add up the sums.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import week_start
from ..sources.commits import commit_together
from ..sources.tables import Slices, VersionedTable
from . import reports

#: What the sums are kept by: a row for each day and channel, whatever the sales.
BY = ("sales_date", "sales_channel")


class DailySums:
    """Partial sums of a fact table that is cut by ``sales_date``.

    ``slices`` must be the fact's own: then a slice of the sums follows from the
    same slice of the fact alone. Both tables share a record of commits, which
    also says which version of the fact the sums are of.
    """

    def __init__(self, fact: VersionedTable, path: str, slices: Callable[[str], Slices]):
        if fact.commits is None:
            raise ValueError("sums need the fact's record of commits")
        self.fact, self.commits = fact, fact.commits
        name = f"{fact.name}/daily_sums"
        schema = reports.partials(fact.read(), BY).schema
        self.table = VersionedTable(fact.spark, path, schema, slices("sales_date"), commits=self.commits, name=name)
        self._basis = f"basis/{name}"

    def refresh(self) -> set[str] | None:
        """Bring the sums up to the fact's version in force; the slices that were
        totalled, or None if all were."""
        of = self.commits.current().get(self._basis)
        if of is None or not self.table.exists():
            draft, touched = self.table.draft(reports.partials(self.fact.read(), BY)), None
        else:
            touched = self.fact.slices_since(of)
            if not touched:
                return touched
            draft = self.table.draft_slices(reports.partials(self.fact.only(touched), BY), touched)
        commit_together([draft], "daily sums", {self._basis: self.fact.version})
        return touched

    def read(self) -> DataFrame:
        """The stored sums; call ``refresh`` first for those of the fact as it is."""
        return self.table.read()

    def weekly_by_channel(self) -> DataFrame:
        return reports.from_partials(self.read().withColumn("week", week_start("sales_date")), ["week", "sales_channel"])

    def month_comparison(self, month: int = 2, year: int = 2020, base_year: int = 2019) -> DataFrame:
        return reports.month_comparison(self.read(), month, year, base_year, "_total")

    def revenue_by_year(self) -> DataFrame:
        """Years in order, as ``reports.revenue_by_year`` gives them."""
        year = F.year("sales_date").alias("sales_year")
        found = reports.from_partials(self.read().withColumn("sales_year", year), ["sales_year"])
        return found.select("sales_year", "transactions", "tickets_sold", F.round("total_sales", 2).alias("revenue")).orderBy("sales_year")

    def measures(self) -> DataFrame:
        return reports.from_partials(self.read(), [])

    def measures_by_year(self) -> DataFrame:
        return reports.from_partials(self.read().withColumn("year", F.year("sales_date")), ["year"])
