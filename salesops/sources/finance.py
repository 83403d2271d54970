"""The finance model: dictionary, posting and staging structures, seed rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS: dict[str, str] = {
    "dic_client": "id_client bigint, client_name string, create_date date, valid_to date, is_del boolean",
    "dic_agreement": "id_agreement bigint, agreement_name string, create_date date, valid_to date, is_del boolean",
    "dic_account": "id_account bigint, account_name string, id_client bigint, account_description string, "
    "id_bal2 int, valid_to date",
    "dic_bal2_version": "id_bal2_version int, version_name string, is_del boolean",
    "dic_bal2": "id_bal2 int, name string, description string, id_bal2_parent int, valid_to date, id_del boolean, "
    "id_bal2_version int",
    "fct_carry": "id_carry bigint, carry_date timestamp_ntz, carry_ground string, id_account bigint, "
    "id_agreement bigint, vl decimal(28,12), src_date timestamp_ntz, extra_data string",
    "dm_rest": "id_period int, id_calc int, id_corr int, id_type int, id_client bigint, id_account bigint, "
    "id_agreement bigint, value decimal(28,12)",
    "buf_fct_carry": "carry_date timestamp_ntz, turnover_sum double, account_name string, agreement_name string, "
    "client_name string, carry_ground string, bal2 string, extra_data string",
}

MAX_LENGTHS: dict[str, dict[str, int]] = {
    "dic_client": {"client_name": 512},
    "dic_agreement": {"agreement_name": 512},
    "dic_account": {"account_name": 20, "account_description": 512},
    "dic_bal2": {"name": 5, "description": 512},
    "dic_bal2_version": {"version_name": 1024},
    "fct_carry": {"carry_ground": 1024},
    "buf_fct_carry": {"account_name": 20, "agreement_name": 512, "carry_ground": 512, "bal2": 5, "extra_data": 512},
}

FAR_FUTURE = dt.date(2099, 1, 1)

# The chart version and the first-order accounts every ledger starts with.
BAL2_VERSIONS = [{"version_name": "706"}]
BAL2_ACCOUNTS = [
    {"name": "*", "description": "План счетов верхний уровень"},
    {"name": "60", "description": "Расчёты с поставщиками и подрядчиками"},
    {"name": "62", "description": "Расчеты с покупателями и заказчиками"},
    {"name": "66", "description": "Расчеты по краткосрочным кредитам и займам"},
    {"name": "67", "description": "Расчеты по долгосрочным кредитам и займам"},
    {"name": "68", "description": "Расчеты по налогам и сборам"},
    {"name": "79", "description": "Внутрихозяйственные расчеты"},
]


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def dictionary_defaults(today: Column | None = None) -> dict[str, Column]:
    """Defaults of a named dictionary: created today, valid until 2099, not deleted."""
    return {
        "create_date": today if today is not None else F.current_date(),
        "valid_to": F.lit(FAR_FUTURE),
        "is_del": F.lit(False),
    }


def seed_bal2_version(spark: SparkSession) -> DataFrame:
    rows = [(i, r["version_name"], False) for i, r in enumerate(BAL2_VERSIONS, 1)]
    return spark.createDataFrame(rows, SCHEMAS["dic_bal2_version"])


def seed_bal2(spark: SparkSession) -> DataFrame:
    """The starting chart of accounts; every row hangs under the top row (id 1)."""
    rows = [(i, r["name"], r["description"], 1, FAR_FUTURE, False, 1) for i, r in enumerate(BAL2_ACCOUNTS, 1)]
    return spark.createDataFrame(rows, SCHEMAS["dic_bal2"])
