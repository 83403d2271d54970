"""Finance reports: seeds, checks, dictionaries and reconciliation, over postings made from orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesops.functions.dates import resolve_period
from salesops.functions.texts import concat_text
from salesops.operators.dml import assign_ids, extend_dictionary, insert_rows, seed_rows, with_defaults
from salesops.operators.predicates import in_period
from salesops.operators.quality import check_fields, check_foreign_key, check_primary_key
from salesops.operators.staging import active, reconcile, resolve_ids, staging_buffer
from salesops.sources import finance, sales
from salesops.sources.facts import store_by_month
from salesops.sources.storage import materialize, work_dir
from salesops.sources.tables import load

CREATED = dt.date(1995, 1, 1)


def staged_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One staged posting per order, each of them delivered twice."""
    return _postings(spark, sf_dir).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sales.orders(spark, sf_dir)
    clients = sales.customers(spark, sf_dir)
    return orders.join(clients, "customer_id").select(
        F.col("order_ts").alias("carry_date"),
        sales.money("total_cents").alias("turnover_sum"),
        concat_text(F.lit("A"), F.col("customer_id")).alias("account_name"),
        concat_text(F.col("priority"), F.lit("/"), F.col("segment")).alias("agreement_name"),
        F.col("customer_name").alias("client_name"),
        F.col("status").alias("carry_ground"),
        F.when(F.col("segment") == "BUILDING", "60").otherwise("62").alias("bal2"),
        concat_text(F.lit("nation="), F.col("nation_id")).alias("extra_data"),
    )


def known_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client dictionary so far: customers who owe nothing; those of segment BUILDING are marked deleted."""
    rows = sales.customers(spark, sf_dir).filter(F.col("balance") >= 0).select(
        (F.col("customer_id") + 1).alias("id_client"), F.col("customer_name").alias("client_name"),
        (F.col("segment") == "BUILDING").alias("is_del"))
    filled = with_defaults(rows, finance.dictionary_defaults(F.lit(CREATED)))
    return filled.select("id_client", "client_name", "create_date", "valid_to", "is_del")


def known_agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The agreements of finished orders, numbered by name."""
    names = _postings(spark, sf_dir).filter(F.col("carry_ground") == "F").select("agreement_name").distinct()
    rows = assign_ids(names, "id_agreement", [F.col("agreement_name")])
    filled = with_defaults(rows, finance.dictionary_defaults(F.lit(CREATED)))
    return filled.select("id_agreement", "agreement_name", "create_date", "valid_to", "is_del")


def known_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per customer; it belongs to the client of that customer, whether the client is known or not."""
    return sales.customers(spark, sf_dir).select(
        (F.col("customer_id") + 1001).alias("id_account"),
        concat_text(F.lit("A"), F.col("customer_id")).alias("account_name"),
        (F.col("customer_id") + 1).alias("id_client"),
        F.when(F.col("segment") != "BUILDING", concat_text(F.col("segment"), F.lit(" of nation "), F.col("nation_id"))).alias(
            "account_description"),
        F.when(F.col("segment") == "BUILDING", 2).otherwise(3).alias("id_bal2"),
        F.lit(finance.FAR_FUTURE).alias("valid_to"),
    )


def seed_and_validate_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded chart of accounts with the number of client accounts under each of its rows, and the
    number of broken rules per check."""
    chart = finance.seed_bal2(spark)
    accounts = known_accounts(spark, sf_dir)
    used = accounts.groupBy("id_bal2").agg(F.count(F.lit(1)).alias("accounts"))
    fields = check_fields(accounts, ["id_account"], ["account_name", "account_description"], finance.MAX_LENGTHS["dic_account"])
    orphans = check_foreign_key(accounts, known_clients(spark, sf_dir), {"id_client": "id_client"})
    chart_orphans = check_foreign_key(accounts, chart, {"id_bal2": "id_bal2"})
    doubles = check_primary_key(accounts, ["id_account"])
    version_orphans = check_foreign_key(chart, finance.seed_bal2_version(spark), {"id_bal2_version": "id_bal2_version"})

    def broken(df: DataFrame):
        return df.agg(F.count(F.lit(1))).scalar()

    return chart.join(used, "id_bal2", "left").select(
        "id_bal2", "name", "description", "id_bal2_parent", "valid_to",
        F.coalesce("accounts", F.lit(0)).alias("accounts"),
        broken(fields).alias("broken_fields"), broken(orphans).alias("without_client"),
        broken(chart_orphans).alias("without_chart"), broken(doubles).alias("double_ids"),
        broken(version_orphans).alias("without_version"),
    )


def check_account_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts whose description is missing or longer than 22 characters, or whose name is longer than 4."""
    return check_fields(known_accounts(spark, sf_dir), ["id_account"], ["account_name", "account_description"],
                        {"account_name": 4, "account_description": 22})


def check_account_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts of clients who are not in the dictionary."""
    return check_foreign_key(known_accounts(spark, sf_dir), known_clients(spark, sf_dir), {"id_client": "id_client"}).select(
        "id_account", "id_client")


def check_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose (order, line number) is not unique."""
    return check_primary_key(sales.lines(spark, sf_dir), ["order_id", "line_no"])


def dictionary_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client dictionary extended by the staged names it does not have."""
    known = known_clients(spark, sf_dir)
    return extend_dictionary(known, staged_postings(spark, sf_dir), "client_name", "id_client",
                             defaults=finance.dictionary_defaults(F.lit(dt.date(2001, 1, 1))))[0]


def dictionary_upsert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows added by that."""
    known = known_clients(spark, sf_dir)
    added = extend_dictionary(known, staged_postings(spark, sf_dir), "client_name", "id_client",
                              defaults=finance.dictionary_defaults(F.lit(dt.date(2001, 1, 1))))[1]
    return added.select(F.lit("INSERT").alias("action"), "id_client", "client_name")


def insert_reports_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client dictionary with a literal row inserted: next id, default dates."""
    known = known_clients(spark, sf_dir)
    seed = seed_rows(known.select("client_name"), [{"client_name": "Seed client"}])
    return insert_rows(known, seed, "id_client", [F.col("client_name")], finance.dictionary_defaults(F.lit(CREATED)))


def account_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts extended by the staged accounts that are unknown, each with its client's id and chart row.

    The accounts so far are those of known clients; the staged names are resolved against the extended client dictionary.
    """
    stage = staged_postings(spark, sf_dir)
    known = known_clients(spark, sf_dir)
    clients = materialize(extend_dictionary(known, stage, "client_name", "id_client",
                                            defaults=finance.dictionary_defaults(F.lit(CREATED)))[0])
    accounts = known_accounts(spark, sf_dir).join(known.select("id_client"), "id_client", "left_semi")
    accounts = accounts.select("id_account", "account_name", "id_client", "id_bal2", "valid_to")
    named = stage.select("account_name", "client_name", "bal2").distinct().join(clients.select("client_name", "id_client"), "client_name", "left")
    chart = finance.seed_bal2(spark).select(F.col("name").alias("bal2"), "id_bal2")
    named = named.join(chart, "bal2", "left")
    return extend_dictionary(accounts, named, "account_name", "id_account",
                             attributes={"id_client": F.max("id_client"), "id_bal2": F.max("id_bal2")},
                             defaults={"valid_to": F.lit(finance.FAR_FUTURE)})[0]


def staging_resolve(spark: SparkSession, sf_dir: str, mode: str = "previous period",
                    today: dt.date = dt.date(1998, 4, 5)) -> DataFrame:
    """The staged postings of the current or previous month, each once, with the ids of the active clients,
    agreements and accounts."""
    year, month = resolve_period(mode, today)
    now = F.lit(dt.date(year, month, 1))
    clients = active(known_clients(spark, sf_dir), now)
    buffer = staging_buffer(staged_postings(spark, sf_dir), year, month)
    resolved = resolve_ids(buffer, clients, active(known_agreements(spark, sf_dir), now), known_accounts(spark, sf_dir))
    return resolved.select("carry_date", "turnover_sum", "client_name", "carry_ground", "extra_data",
                           "id_client", "id_agreement", "id_account")


def _reconciliation_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Incoming postings of all orders, and the postings stored before: finished orders are the same,
    open ones were stored one unit higher, partly delivered ones not at all, and returned lines were
    stored although they are no longer delivered."""
    clients = sales.customers(spark, sf_dir).select("customer_id", "nation_id")
    orders = sales.orders(spark, sf_dir)
    base = orders.join(clients, "customer_id").select(
        "order_id",
        F.col("order_date").alias("carry_date"),
        (F.col("customer_id") + 1).alias("id_client"),
        (F.col("customer_id") + 1001).alias("id_account"),
        F.col("priority").alias("agreement"),
        F.col("status").alias("carry_ground"),
        concat_text(F.lit("nation="), F.col("nation_id")).alias("extra_data"),
        (F.col("total_cents").cast("decimal(20,0)") / 100).cast("decimal(28,12)").alias("vl"),
    ).withColumn("id_agreement", F.left("agreement", F.lit(1)).cast("bigint"))
    columns = ["carry_date", "id_client", "id_account", "id_agreement", "carry_ground", "extra_data", "vl"]
    incoming = base.select(columns)
    raised = F.when(F.col("carry_ground") == "O", F.col("vl") + 1).otherwise(F.col("vl")).cast("decimal(28,12)")
    kept = base.filter(F.col("carry_ground") != "P").withColumn("vl", raised).select(columns)
    sent_back = sales.lines(spark, sf_dir).filter(F.col("return_flag") == "R").groupBy("order_id").agg(
        F.sum("amount_cents").alias("sum_cents"))
    returned = base.drop("vl").join(sent_back, "order_id").withColumn("carry_ground", F.lit("return")).withColumn(
        "vl", (-F.col("sum_cents").cast("decimal(20,0)") / 100).cast("decimal(28,12)")).select(columns)
    return incoming, kept.unionByName(returned)


def posting_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings to append so that the stored sums become the incoming ones."""
    incoming, stored = _reconciliation_sides(spark, sf_dir)
    return reconcile(incoming, stored).withColumn("vl", F.col("vl").cast("double"))


def posting_reconcile_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run after appending: nothing is left to do. One row with the number of postings
    appended by the first and by the second run."""
    incoming, stored = _reconciliation_sides(spark, sf_dir)
    emitted = materialize(reconcile(incoming, stored))
    after = stored.unionByName(emitted.select(stored.columns))
    second = reconcile(incoming, after)
    return emitted.agg(F.count(F.lit(1)).alias("first_run")).withColumn("second_run", second.agg(F.count(F.lit(1))).scalar())


def postings_in_period(spark: SparkSession, sf_dir: str, start: dt.date = dt.date(1998, 3, 1),
                       end: dt.date = dt.date(1998, 5, 31)) -> DataFrame:
    """Stored postings of a period of days, per ground."""
    rows = in_period(load(spark, sf_dir, "orders"), "o_orderdate", start, end)
    return rows.groupBy(F.col("o_orderstatus").alias("carry_ground")).agg(F.count(F.lit(1)).alias("postings"))


def postings_in_period_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from postings stored by month: only the three months' files are read."""
    return postings_in_period(spark, store_by_month(spark, sf_dir, work_dir(spark, "months"), ("orders",)))
