"""The six table layouts of the monthly extracts."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

_TYPES = {"STRING": StringType(), "DOUBLE": DoubleType()}

# Columns in file order.
_LAYOUTS = {
    "loan_assign": """
        bib_id STRING, date_key STRING, fake_id STRING, nid_hash STRING, loan_id STRING,
        loan_amount DOUBLE, date_timestamp STRING""",
    "loan_fee": """
        bib_id STRING, date_key STRING, fake_id STRING, nid_hash STRING, loan_id STRING,
        loan_amount DOUBLE, hsdp_fee DOUBLE, date_timestamp STRING""",
    "loan_recovery": """
        bib_id STRING, date_key STRING, fake_id STRING, nid_hash STRING, loan_id STRING,
        loan_amount DOUBLE, hsdp_recovery DOUBLE, date_timestamp STRING""",
    "package": """
        bib_id STRING, date_key STRING, fake_id STRING, nid_hash STRING, offering_code STRING,
        offer_amount DOUBLE, offering_name STRING, activation_date STRING,
        deactivation_date STRING""",
    "recharge": """
        bib_id STRING, date_key STRING, fake_id STRING, nid_hash STRING,
        recharge_value_amt DOUBLE, recharge_dt STRING, origin_host_nm STRING,
        account_balance_before_amt DOUBLE, account_balance_after_amt DOUBLE""",
    "user": """
        bib_id STRING, fake_id STRING, nid_hash STRING, contract_type_v STRING, gender_v STRING,
        registration_date_d STRING, date_of_birth_d STRING, ability_status STRING,
        account_balance DOUBLE, base_station_cd STRING, sitei STRING""",
}



def _layout(text: str) -> StructType:
    """Columns and types side by side; read here, as Spark's parser wants a running session."""
    pairs = [column.split() for column in text.split(",")]
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


SCHEMAS: dict[str, StructType] = {key: _layout(text) for key, text in _LAYOUTS.items()}


def schema_for(key: str) -> StructType:
    """Layout of a table; ``KeyError`` for a table that is not known."""
    if key not in SCHEMAS:
        raise KeyError(f"unknown table {key!r}: expected one of {list(SCHEMAS)}")
    return SCHEMAS[key]
