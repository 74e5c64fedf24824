"""Ticket-sales tables derived from the given star schema.

Every raw table is a plain expression over whole given tables. Values carry
blanks, odd cases, impossible dates and missing references on purpose, by rules
over the data itself, so that cleansing and checks have work to do:

organizers   nations                        resellers  suppliers
customers    customers                      events     parts
agreements   supplier and each nation of its region, two periods, two versions
ticket sales latest version of each line item, with its order
daily sales  events, the type in the customer's first name

Customers and suppliers in debt carry an id of another prefix, so that their
sales refer to a customer or reseller that is not there.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import SYSTEM_DATABASE, SYSTEM_FILES
from ..operators.latest import latest_by

# Schemas of the given, read-only files, so that footers are read once.
_SCHEMAS: dict[str, T.StructType] = {}

TABLES_LOADED = "2002-01-01 00:00:00"
FILES_LOADED = "2024-02-01 00:00:00"


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def code(prefix: str, number: Column | str, width: int = 9) -> Column:
    n = F.col(number) if isinstance(number, str) else number
    return F.concat(F.lit(prefix), F.lpad(n.cast("string"), width, "0"))


def _db(updated_at: Column) -> dict[str, Column]:
    return {
        "batch_id": F.lit(" BATCH_1 "),
        "load_ts": ts(TABLES_LOADED),
        "source_system": F.lit(SYSTEM_DATABASE),
        "updated_at": updated_at,
    }


def _columns(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


class Domain:
    """Raw tables over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._given: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._given:
            path = f"{self.folder}/{name}.parquet"
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._given[name] = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return self._given[name]

    def organizers(self) -> DataFrame:
        joined = self("nation").join(self("region"), F.expr("n_regionkey = r_regionkey"))
        return joined.select(
            *_columns(
                {
                    "organizer_id": code("ORG", "n_nationkey", 3),
                    "organizer_name": F.concat(F.lit("  "), "n_name", F.lit(" ")),
                    "country": F.col("r_name"),
                    "region": F.concat(F.lower("r_name"), F.lit(" ")),
                    **_db(ts("1994-12-31 00:00:00")),
                }
            )
        )

    def resellers(self) -> DataFrame:
        joined = (
            self("supplier")
            .join(self("nation"), F.expr("s_nationkey = n_nationkey"))
            .join(self("region"), F.expr("n_regionkey = r_regionkey"))
        )
        return joined.select(
            *_columns(
                {
                    "reseller_id": F.when(
                        F.col("s_acctbal") >= 0, code(" RES", "s_suppkey")
                    ).otherwise(code(" REX", "s_suppkey")),
                    "reseller_name": F.concat("s_name", F.lit(" ")),
                    "country": F.lower("n_name"),
                    "region": F.lower("r_name"),
                    **_db(ts("1994-12-31 00:00:00")),
                }
            )
        )

    def customers(self) -> DataFrame:
        joined = (
            self("customer")
            .join(self("nation"), F.expr("c_nationkey = n_nationkey"))
        )
        return joined.select(
            *_columns(
                {
                    "customer_id": F.when(
                        F.col("c_acctbal") >= 0, code("CUST", "c_custkey")
                    ).otherwise(code("CUSX", "c_custkey")),
                    "first_name": F.concat(F.lit(" "), F.lower("c_mktsegment")),
                    "last_name": F.concat_ws("-", "n_name", "c_mktsegment"),
                    "email": F.concat(F.upper("c_name"), F.lit("@EXAMPLE.ORG ")),
                    "country": F.col("n_name"),
                    **_db(ts("1994-12-31 00:00:00")),
                }
            )
        )

    def events(self) -> DataFrame:
        brand = F.expr("CAST(substring(p_brand, 7) AS INT) - 1")
        parts = self("part").withColumn("brand", brand)
        joined = parts.join(
            self("nation"), F.expr("brand = n_nationkey"), "left"
        ).join(self("region"), F.expr("n_regionkey = r_regionkey"), "left")
        day = F.format_string(
            "%04d-%02d-%02d",
            F.expr("1995 + p_size % 7"),
            F.expr("p_size % 13"),
            F.expr("p_size % 29"),
        )
        return joined.select(
            *_columns(
                {
                    "event_id": code("EVT", "p_partkey"),
                    "organizer_id": code(" ORG", "brand", 3),
                    "event_name": code("Show ", "p_partkey"),
                    "event_type": F.concat("p_type", F.lit(" ")),
                    "venue": F.concat(F.lit(" "), "p_name", F.lit(" hall")),
                    "region": F.lower("r_name"),
                    "event_date": day,
                    **_db(ts("1994-12-31 00:00:00")),
                }
            )
        )

    def commission_agreements(self) -> DataFrame:
        home = self("nation").selectExpr("n_nationkey AS home", "n_regionkey AS region")
        owner = self("nation").selectExpr("n_nationkey AS owner", "n_regionkey AS o_region")
        pairs = (
            self("supplier")
            .join(home, F.expr("s_nationkey = home"))
            .join(owner, F.expr("region = o_region"))
        )
        # Preferred resellers keep the first period for another year: overlap.
        versions = F.expr(
            """inline(transform(sequence(0, 3), i -> struct(
                i DIV 2 AS period,
                i % 2 AS revision,
                if(i < 2, '1995-01-01', '1998-07-01') AS effective_from,
                CASE WHEN i >= 2 THEN NULL
                     WHEN s_acctbal > 9000 THEN '1999-06-30'
                     ELSE '1998-06-30' END AS effective_to)))"""
        )
        rate = F.expr(
            """CAST(CAST(s_acctbal AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))
                 + owner * CAST(0.01 AS DECIMAL(3,2))
                 + revision * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(12,4))"""
        ).cast("string")
        number = F.expr("(s_suppkey * 25 + owner) * 4 + period * 2 + revision")
        return pairs.select("s_suppkey", "s_acctbal", "owner", versions).select(
            *_columns(
                {
                    "agreement_id": number.cast("string"),
                    "organizer_id": code("org", "owner", 3),
                    "reseller_id": code("res", "s_suppkey"),
                    "commission_rate": rate,
                    "effective_from": F.col("effective_from"),
                    "effective_to": F.col("effective_to"),
                    **_db(
                        F.when(F.col("revision") == 0, ts("1994-06-01 00:00:00")).otherwise(
                            ts("1994-12-01 00:00:00")
                        )
                    ),
                }
            )
        )

    def latest_lines(self, together: Sequence[str] = ()) -> DataFrame:
        newest = [
            F.col(c).desc()
            for c in (
                "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                "l_linestatus",
            )
        ]
        return latest_by(self("lineitem"), ["l_orderkey", "l_linenumber"], newest, together)

    def ticket_sales(self) -> DataFrame:
        joined = self.latest_lines(["l_orderkey"]).join(
            self("orders"), F.expr("l_orderkey = o_orderkey")
        )
        direct = F.col("l_returnflag") == "N"
        organizer = code("ORG", F.expr("l_suppkey % 25"), 3)
        reseller = code("RES", "l_suppkey")
        seller = F.when(direct, organizer).otherwise(reseller)
        channel = F.expr(
            """CASE o_orderpriority WHEN '1-URGENT' THEN 'web'
                 WHEN '2-HIGH' THEN 'Mobile_App ' WHEN '3-MEDIUM' THEN ' on_site'
                 WHEN '5-LOW' THEN 'Web' ELSE 'facebook' END"""
        )
        return joined.select(
            *_columns(
                {
                    "ticket_id": F.concat(
                        code(" TKT", "l_orderkey", 12), F.lit("-"), "l_linenumber"
                    ),
                    "event_id": code("EVT", "l_partkey"),
                    "organizer_id": organizer,
                    "reseller_id": F.when(direct, F.lit(" ")).otherwise(
                        F.concat(reseller, F.lit(" "))
                    ),
                    "seller_type": F.when(direct, "organizer").otherwise(" reseller"),
                    "seller_id": seller,
                    "seller_name": F.concat(F.lit("seller "), seller),
                    "customer_id": code("CUST", "o_custkey"),
                    "sales_channel": channel,
                    "quantity": F.expr(
                        """IF(round(l_discount * 100) = 10 AND round(l_tax * 100) = 8,
                              0, CAST(l_quantity AS INT))"""
                    ),
                    "unit_price": F.expr(
                        """CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT)
                              DIV CAST(l_quantity AS BIGINT) AS DECIMAL(18,0))
                            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"""
                    ),
                    "total_amount": F.expr(
                        """CAST(IF(l_discount = 0 AND l_tax = 0, -l_extendedprice,
                              l_extendedprice) AS DECIMAL(12,2))"""
                    ),
                    "purchase_date": F.col("o_orderdate").cast("date").cast("string"),
                    **_db(F.col("l_shipdate")),
                }
            )
        )

    def reseller_daily_sales(self) -> DataFrame:
        buys = self("events")
        show = F.get_json_object("props", "$.k")
        channel = F.expr(
            """CASE user_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile_app '
                 ELSE 'on_site' END"""
        )
        file = F.concat(
            F.lit("DailySales_"), F.date_format("ts", "MMddyyyy"),
            code("_RES", "user_id"), F.lit(".csv"),
        )
        return buys.select(
            *_columns(
                {
                    "transaction_id": F.concat(F.lit(" "), "event_id", F.lit(" ")),
                    "reseller_id": code("res", "user_id"),
                    "event_name": F.concat(code("  show ", show), F.lit(" ")),
                    "number_of_purchased_tickets": F.expr("event_id % 7"),
                    "total_amount": F.col("value").cast("decimal(12,2)"),
                    "sales_channel": channel,
                    "customer_first_name": F.concat(F.lit("anna-"), "event_type"),
                    "customer_last_name": F.concat(F.lit(" van der_berg "), "user_id"),
                    "office_location": F.concat(F.lit(" office "), "user_id"),
                    "created_date": F.col("ts").cast("date").cast("string"),
                    "source_file_name": file,
                    "batch_id": F.lit("BATCH_2"),
                    "updated_at": ts(FILES_LOADED),
                    "load_ts": ts(FILES_LOADED),
                    "source_system": F.lit(SYSTEM_FILES),
                }
            )
        )

    def raw(self) -> "Lazy":
        return Lazy(
            {
                "organizers": self.organizers,
                "resellers": self.resellers,
                "customers": self.customers,
                "events": self.events,
                "commission_agreements": self.commission_agreements,
                "ticket_sales": self.ticket_sales,
                "reseller_daily_sales": self.reseller_daily_sales,
            }
        )


class Lazy(Mapping):
    """Tables that are planned when first asked for."""

    def __init__(self, build: dict[str, Callable[[], DataFrame]]):
        self._build, self._done = build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._done:
            self._done[name] = self._build[name]()
        return self._done[name]

    def __iter__(self):
        return iter(self._build)

    def __len__(self):
        return len(self._build)
