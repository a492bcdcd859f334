"""Explicit schemas of the landed payload files (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T


def _arr(t):
    return T.ArrayType(t, True)


ESTIMATE_PAYLOAD = T.StructType([
    T.StructField("customer", T.StringType(), True),
    T.StructField("commited_at", T.LongType(), True),
    T.StructField("st", T.LongType(), True),
    T.StructField("data", _arr(T.StructType([
        T.StructField("timestamps", _arr(T.LongType()), True),
        T.StructField("main_pwrs", _arr(T.DoubleType()), True),
        T.StructField("app_type", _arr(T.StructType([
            T.StructField("app_id", T.IntegerType(), True),
            T.StructField("apps", _arr(T.StructType([
                T.StructField("id", T.IntegerType(), True),
                T.StructField("pwrs", _arr(T.DoubleType()), True),
            ])), True),
        ])), True),
    ])), True),
])

ACTIVITY_PAYLOAD = T.StructType([
    T.StructField("customer", T.StringType(), True),
    T.StructField("fixed_at", T.LongType(), True),
    T.StructField("st", T.LongType(), True),
    T.StructField("data", _arr(T.StructType([
        T.StructField("timestamps", _arr(T.LongType()), True),
        T.StructField("appliance_types", _arr(T.StructType([
            T.StructField("appliance_type_id", T.IntegerType(), True),
            T.StructField("appliances", _arr(T.StructType([
                T.StructField("appliance_id", T.IntegerType(), True),
                T.StructField("powers", _arr(T.DoubleType()), True),
            ])), True),
        ])), True),
    ])), True),
])

NESTED_ESTIMATE = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("data", _arr(T.StructType([
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("app_types", _arr(T.StructType([
            T.StructField("app_type_id", T.IntegerType(), False),
            T.StructField("apps", _arr(T.StructType([
                T.StructField("app_id", T.IntegerType(), False),
                T.StructField("pwr", T.DoubleType(), True),
            ])), False),
        ])), False),
    ])), False),
])

NESTED_MAIN = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("data", _arr(T.StructType([
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("w_hp", T.DoubleType(), True),
    ])), False),
])
