"""The whole load: two feeds into raw tables, raw tables into the star schema."""

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..fixed import EPOCH_MARK, FILE_NAME_STRICT, SYSTEM_DATABASE
from ..operators.checks import Check, assert_checks, run_checks
from ..operators.incremental import incremental_rows
from ..operators.joins import hot_for
from ..operators.shape import coerce_timestamps, conform, stamp
from ..sources.commits import Commits, commit_together
from ..sources.drops import DropFeed
from ..sources.files import incremental_scan, land, load_by_name
from ..sources.ledgers import Ledgers
from ..sources.tables import Draft, Slices, VersionedTable, key_buckets, months
from . import quality, sales, staging, star

# Independent small tables would each leave most of a cluster idle.
_AT_ONCE = 4
# Name in the record of commits: the raw agreements' version that the whole fact is rated with.
_RATED_WITH = "basis/fact_ticket_sales/commission_agreements"


def _side_by_side(work: Callable[[str], Any], names: Sequence[str]) -> dict[str, Any]:
    """Run independent table jobs a few at a time; the first error is raised."""
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        return dict(zip(names, pool.map(work, names)))


class Warehouse:
    """One warehouse under one folder. Runs are given their id and time, so a
    run can be repeated; one run at a time is assumed.

    Sales are cut by date (``slice_sales``: ``months`` or, for very large tables,
    ``days``), customers and events into ``buckets`` by key: an upsert rewrites
    only the slices it touches, which a directory of the sales' keys tells.

    All tables share one record of the versions in force. The raw tables of a load
    change in one step, and so do dimensions and fact of a build, after every check
    has passed on what they are about to become.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        slice_sales: Callable[[str], Slices] = months,
        buckets: int = 64,
        file_pattern: str = FILE_NAME_STRICT,
        severity: str = "error",
        as_of: str = "current_date()",
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.severity, self.as_of = severity, as_of
        self.slice_sales = slice_sales
        self.ledgers = Ledgers(spark, f"{self.root}/audit")
        self.commits = Commits(spark, f"{self.root}/commits")
        slices = {
            "ticket_sales": slice_sales("purchase_date"),
            "customers": key_buckets(["customer_id"], buckets),
            "events": key_buckets(["event_id"], buckets),
        }
        self.raw = {
            name: self._table(
                f"raw/{name}", schema, slices.get(name),
                ["ticket_id"] if name == "ticket_sales" else (),
            )
            for name, schema in schemas.RAW.items()
        }
        self.feed = DropFeed(
            spark, self.raw["reseller_daily_sales"], self.ledgers, file_pattern
        )
        self.fact = self._table(
            "mart/fact_ticket_sales", schemas.FACT, slice_sales("sales_date"), ["sales_key"],
            {"sales_key": star.sales_key()},
        )

    def _table(
        self, name: str, schema, slices: Slices | None = None, keys: Sequence[str] = (),
        derived: Mapping[str, Column] | None = None,
    ) -> VersionedTable:
        return VersionedTable(
            self.spark, f"{self.root}/{name}", schema, slices,
            commits=self.commits, name=name, keys=keys, derived=derived,
        )

    # -- feeds ------------------------------------------------------------

    def load_tables(
        self, sources: Mapping[str, DataFrame], batch_id: str, run_ts: Column
    ) -> dict[str, int]:
        """Changed rows of the source tables into the raw tables, by key.

        All merges are written first and come in force in one step, then the
        watermarks move. Of a run that dies before that step readers see nothing;
        after it the run is repeated in full, and the keyed merge makes that harmless.
        """

        def merge(name: str) -> tuple[dict, Draft | None]:
            # Times that come as text and are none become null; the load goes on.
            kinds = dict(sources[name].dtypes)
            times = [
                f.name
                for f in schemas.RAW[name]
                if isinstance(f.dataType, T.TimestampNTZType) and kinds.get(f.name) == "string"
            ]
            source = coerce_timestamps(sources[name], times)
            changed = incremental_scan(source, self.ledgers.watermark(name))
            rows = conform(
                stamp(changed, batch_id, SYSTEM_DATABASE, run_ts), schemas.RAW[name]
            )
            table = self.raw[name]
            if not table.row_count():
                # Nothing to merge with: written once, not landed first.
                draft = table.draft(rows)
                return {"rows": draft.row_count(), "mark": draft.newest()}, draft
            folder = f"{self.root}/landing/{name}/batch_id={batch_id}"
            seen = land(rows, folder)
            if not seen["rows"]:
                return seen, None
            delta = load_by_name(self.spark, folder, schemas.RAW[name])
            return seen, table.draft_upsert(delta, *schemas.SOURCE_KEYS[name])

        try:
            merged = _side_by_side(merge, list(sources))
            seen = {name: s for name, (s, _) in merged.items()}
            commit_together([d for _, d in merged.values() if d], batch_id)
            counts = {name: s["rows"] for name, s in seen.items()}
            for name, s in seen.items():
                if s["rows"]:
                    self.ledgers.set_watermark(name, s["mark"], batch_id, run_ts)
        except Exception as error:
            self._audit("load_tables", run_ts, "FAILED", 0, 0, str(error))
            raise
        self._audit("load_tables", run_ts, "SUCCESS", sum(counts.values()), 0, None)
        return counts

    def load_files(self, folder: str, batch_id: str, run_ts: Column) -> dict:
        with self._audited("load_files", run_ts):
            done = self.feed.load(folder, batch_id, run_ts)
        self._audit("load_files", run_ts, "SUCCESS", done["rows"], done["files"], None)
        return done

    def _audit(self, job, run_ts, status, rows, files, error) -> None:
        self.ledgers.jobs.add(
            job_name=job, start_time=run_ts, end_time=F.current_timestamp(),
            status=status, records_loaded=rows, files_processed=files,
            error_message=error,
        )

    @contextmanager
    def _audited(self, job: str, run_ts: Column) -> Iterator[None]:
        """A failed run leaves its row and its whole message."""
        try:
            yield
        except Exception as error:
            self._audit(job, run_ts, "FAILED", 0, 0, str(error))
            raise

    def full_reload(self, batch_id: str, run_ts: Column) -> None:
        """Empty raw tables, marks at the start of time, no file known; then load
        again. Staging and fact stay until the next build brings the rows back
        under the same keys.
        """
        commit_together([table.draft_empty() for table in self.raw.values()], batch_id)
        for name in self.raw:
            if name in schemas.SOURCES:
                epoch = F.lit(EPOCH_MARK).cast("timestamp_ntz")
                self.ledgers.set_watermark(name, epoch, batch_id, run_ts)

    # -- models -----------------------------------------------------------

    def staged(self) -> dict[str, DataFrame]:
        return staging.stage_all({n: t.read() for n, t in self.raw.items()})

    def _gate(
        self,
        tables: Mapping[str, DataFrame],
        checks: Sequence[Check],
        batch_id: str,
        run_ts: Column,
    ) -> None:
        """Log the checks; a failed one stops the models downstream."""
        results = run_checks(tables, checks)
        # One row a check. Only this run's results decide, not what an earlier
        # run under the same id has left in the ledger.
        log = self.spark.createDataFrame(results.collect(), results.schema)
        self.ledgers.checks.append(
            log.withColumns({"batch_id": F.lit(batch_id), "checked_at": run_ts})
        )
        assert_checks(log, self.severity)

    def _checks(self, prefix: str) -> list[Check]:
        return [
            c for c in quality.model_checks(as_of=self.as_of) if c.table.startswith(prefix)
        ]

    def build(
        self,
        batch_id: str,
        run_ts: Column,
        by: str | None = None,
        rebuild_sales: bool = True,
        rerate: bool = False,
    ) -> dict[str, int]:
        """See ``_build``; a failed build leaves a row in the job audit."""
        with self._audited("build", run_ts):
            return self._build(batch_id, run_ts, by, rebuild_sales, rerate)

    def _build(
        self, batch_id: str, run_ts: Column, by: str | None, rebuild_sales: bool, rerate: bool
    ) -> dict[str, int]:
        """Staging, unified sales, dimensions and the incremental fact.

        Each is written as a draft, checked, and comes in force only if its checks
        pass; dimensions and fact together.

        by             keep the fact's mark per value of a column (see
                       ``incremental_rows``) instead of one mark over both feeds
        rebuild_sales  write the unified sales anew, so that changed names reach
                       old sales; otherwise only sales changed since are merged
        rerate         also work out anew the facts of old sales whose agreement has
                       changed since the fact was last built; without it they keep
                       the rate that was in force then
        """
        raw = {n: t.read() for n, t in self.raw.items()}
        tickets = self._table(
            "staging/ticket_sales",
            staging.stg_ticket_sales(raw["ticket_sales"]).schema,
            self.slice_sales("purchase_date"),
            ["ticket_id"],
        )
        mark = tickets.high_mark() if tickets.exists() else None
        draft = tickets.draft_upsert(
            staging.stg_ticket_sales(raw["ticket_sales"], mark=mark), ["ticket_id"]
        )
        staged = staging.stage_all(raw)
        staged["ticket_sales"] = draft.read()
        named = {f"stg_{n}": df for n, df in staged.items()}
        named["stg_commissions"] = named.pop("stg_commission_agreements")
        self._gate(named, self._checks("stg_"), f"{batch_id}-stg", run_ts)
        draft.commit(batch_id)

        hot = sales.hot_sales_keys(staged)
        unified = sales.unified_sales(staged, hot)
        # Read by the fact, the date dimension and the checks: written once.
        stored = self._table(
            "intermediate/sales", unified.schema, self.slice_sales("sales_date"),
            ["sales_id", "sales_source"],
        )
        if rebuild_sales or not stored.exists():
            draft = stored.draft(unified)
        else:
            # The filter is on the sale, so only changed sales are joined.
            changed = incremental_rows(unified, stored.read(), by="source_system")
            draft = stored.draft_upsert(changed, ["sales_id", "sales_source"])
        named["int_sales_transactions"] = draft.read()
        self._gate(named, self._checks("int_"), f"{batch_id}-int", run_ts)
        draft.commit(batch_id)

        dims = {
            n: df
            for n, df in star.star_schema(staged, stored.read()).items()
            if n.startswith("dim_")
        }

        def write(name: str) -> Draft:
            return self._table(f"mart/{name}", dims[name].schema).draft(dims[name])

        drafts = _side_by_side(write, list(dims))
        named |= {name: d.read() for name, d in drafts.items()}
        self._gate(named, self._checks("dim_"), f"{batch_id}-dim", run_ts)

        agreements = staged["commission_agreements"]
        fact = self._draft_fact(stored.read(), agreements, batch_id, by, rerate)
        if fact:
            drafts["fact_ticket_sales"] = fact
        named["fact_ticket_sales"] = fact.read() if fact else self.fact.read()
        self._gate(named, self._checks("fact_"), f"{batch_id}-fact", run_ts)
        # A later build compares the agreements it finds with these.
        basis = {_RATED_WITH: self.raw["commission_agreements"].version}
        commit_together(drafts.values(), batch_id, basis if rerate or _RATED_WITH not in self.commits.current() else {})
        counts = {name: d.row_count() for name, d in drafts.items()}
        counts["fact_ticket_sales"] = self.fact.row_count()
        return counts

    def _draft_fact(
        self, unified: DataFrame, agreements: DataFrame, batch_id: str, by: str | None, rerate: bool
    ) -> Draft | None:
        """The fact with what has changed, or None if nothing has."""
        pairs = hot_for(unified, ["organizer_id", "reseller_id"], agreements)
        if not self.fact.exists():
            return self.fact.draft(star.fact_ticket_sales(unified, agreements, hot=pairs))
        since = {"target": self.fact.read(), "by": by} if by else {"mark": self.fact.high_mark()}
        folder = f"{self.root}/landing/fact_ticket_sales/batch_id={batch_id}"
        if rerate:
            rated = self.raw["commission_agreements"].at(self.commits.current()[_RATED_WITH])
            periods = star.changed_periods(staging.stg_commissions(rated), agreements)
            changed = incremental_rows(unified, **since)
            rows = star.fact_ticket_sales(star.rerated_sales(unified, changed, periods), agreements, hot=pairs)
        else:
            rows = star.fact_ticket_sales(unified, agreements, hot=pairs, **since)
        if not land(rows, folder)["rows"]:
            return None
        landed = self.spark.read.parquet(folder)
        # Columns that the model has gained or lost are taken over.
        same = set(landed.columns) == set(self.fact.schema.fieldNames())
        delta = load_by_name(self.spark, folder, self.fact.schema) if same else landed
        if rerate and same:
            return self.fact.draft_replace(delta, ["sales_key"])
        return self.fact.draft_upsert(delta, ["sales_key"], evolve=not same)

    def vacuum(self) -> int:
        """Delete files that no version in force names; their number. The agreements that
        the fact was rated with stay, for the next build to compare with."""
        kept = self.commits.current().get(_RATED_WITH)
        tables = [*self.raw.items(), ("fact", self.fact)]
        return sum(t.vacuum([kept] if n == "commission_agreements" and kept else ()) for n, t in tables)

    def mart(self) -> dict[str, DataFrame]:
        """The fact and the dimensions as last published."""
        dims = {
            "dim_customer": "customer_id string, first_name string, last_name string, email string",
            "dim_organizer": "organizer_id string, organizer_name string, region string",
            "dim_reseller": "reseller_id string, reseller_name string, region string, country string",
            "dim_event": "event_id string, event_name string, event_type string, event_date date, "
            "venue string, region string, organizer_id string, organizer_name string",
            "dim_date": "date_key date, year int, quarter int, month int, month_name string, "
            "week_number int, day_of_month int",
        }
        tables = {n: self._table(f"mart/{n}", schemas.fields(d)) for n, d in dims.items()}
        return {
            "fact_ticket_sales": self.fact.read(),
            **{n: t.read() for n, t in tables.items()},
        }
