"""Declared schemas of the raw role tables (no schema inference at scale)."""

from pyspark.sql import types as T

LABELS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("is_churn", T.IntegerType()),
])

MEMBERS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("city", T.IntegerType()),
    T.StructField("bd", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("registered_via", T.IntegerType()),
    T.StructField("registration_init_time", T.IntegerType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("payment_method_id", T.IntegerType()),
    T.StructField("payment_plan_days", T.IntegerType()),
    T.StructField("plan_list_price", T.IntegerType()),
    T.StructField("actual_amount_paid", T.IntegerType()),
    T.StructField("is_auto_renew", T.IntegerType()),
    T.StructField("transaction_date", T.IntegerType()),
    T.StructField("membership_expire_date", T.IntegerType()),
    T.StructField("is_cancel", T.IntegerType()),
])

USER_LOGS = T.StructType([
    T.StructField("msno", T.StringType()),
    T.StructField("date", T.IntegerType()),
    T.StructField("num_25", T.IntegerType()),
    T.StructField("num_50", T.IntegerType()),
    T.StructField("num_75", T.IntegerType()),
    T.StructField("num_985", T.IntegerType()),
    T.StructField("num_100", T.IntegerType()),
    T.StructField("num_unq", T.IntegerType()),
    T.StructField("total_secs", T.DoubleType()),
])
