"""Explicit schemas for the driver tables and the reference's input layouts
(FIXTURES.md)."""
from __future__ import annotations

from pyspark.sql import types as T

DRIVER = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
}

# Reference layouts (declared, so the reader never infers over large inputs).
STORE_SALES = "id bigint, date date, store_nbr int, family string, sales double, onpromotion int"
COUNTY_MONTH = ("row_id string, cfips int, county string, state string, first_day_of_month date, "
                "microbusiness_density double, active bigint")
BOOK_SALES = "row_id bigint, date date, country string, store string, product string, num_sold bigint"
PROTEIN_ATOMS = [("record", 1, 6, "string"), ("atom_number", 7, 11, "bigint"), ("atom_name", 13, 16, "string"),
                 ("residue_name", 18, 20, "string"), ("chain", 22, 22, "string"),
                 ("residue_number", 23, 26, "int"), ("x_coord", 31, 38, "double"),
                 ("y_coord", 39, 46, "double"), ("z_coord", 47, 54, "double")]


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DRIVER[name])
