"""Tables in the shape the operators expect, derived from a star schema of orders.

Each text is SQL that both Spark and an independent engine accept, so the same text serves as
input on one side and as the base of the check on the other.  The derivations put in nulls,
NaN, duplicate ids, lookups that miss, and versions that begin during a day.
"""

from __future__ import annotations

from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rankframe.spec import FeatureSpec, ModelShape, PreprocessConfig, SampleConfig

INTERACTIONS_SQL = """
select 'c' || cast(o_custkey as string) as unified_buyer_id,
       nullif(l_partkey, 7) as product_id,
       nullif(l_suppkey, 3) as shop_id,
       cast(l_shipdate as date) as event_timestamp_day,
       l_returnflag = 'R' and l_quantity <= 2 as is_native_order,
       case when l_linenumber <= 4 then 'home_feed'
            when l_linenumber <= 6 then 'boosted_merchants'
            else 'shop_store' end as page_type,
       case when o_orderpriority = '5-LOW' then null
            when o_orderpriority = '4-NOT SPECIFIED' then 'rail_recently_viewed'
            else 'rail_' || lower(substr(o_orderpriority, 3)) end as section_id,
       case when l_discount = 0 then null
            else cast(round(l_discount * 100) as int) end as campaign_id,
       l_quantity as quantity,
       l_extendedprice as price,
       nullif(l_discount, 0) as discount,
       case when l_tax = 0 then cast('NaN' as double) else l_tax end as tax,
       o_totalprice as order_total,
       p_retailprice as retail_price,
       cast(p_size as double) as size,
       c_acctbal as balance,
       p_brand as brand,
       nullif(p_type, 'PROMO') as kind,
       c_mktsegment as segment,
       o_orderpriority as priority,
       o_orderstatus as status
from {lineitem}
join {orders} on l_orderkey = o_orderkey
join {part} on l_partkey = p_partkey
join {customer} on o_custkey = c_custkey
"""

# One version per buyer, kind and day, so the window sees at most one row per calendar day
# of a buyer, however many orders the buyer has.  Vectors join last and are not shuffled by it.
HISTORY_SQL = """
select 'c' || cast(o_custkey as string) as unified_buyer_id,
       interaction_type,
       valid_from,
       valid_to,
       case when o_orderkey % 11 = 0 then null else embedding end
           as user_average_product_search_document_embedding
from (
  select o_custkey, interaction_type, o_orderkey, valid_from,
         lead(valid_from) over (partition by o_custkey, interaction_type order by valid_from) as valid_to,
         o_orderkey % (select count(*) from {embeddings}) as vec
  from (
    select o_custkey, interaction_type, o_orderkey,
           o_orderdate + interval '1' hour * (o_orderkey % 24) as valid_from
    from (
      select o_custkey,
             case when o_orderstatus = 'P' then 'CLICK' else 'ORDER' end as interaction_type,
             o_orderdate,
             max(o_orderkey) as o_orderkey
      from {orders}
      group by o_custkey, case when o_orderstatus = 'P' then 'CLICK' else 'ORDER' end, o_orderdate
    ) as versions
  ) as timed
) as intervals
join {embeddings} on vec_id = vec
"""

# Every tenth product has no vector, every fiftieth has two.
PRODUCT_EMBEDDINGS_SQL = """
select product_id, embedding as product_search_document_embedding
from (
  select p_partkey as product_id,
         p_partkey % (select count(*) from {embeddings}) as vec
  from {part} where p_partkey % 10 <> 0
  union all
  select p_partkey as product_id,
         (p_partkey + 1) % (select count(*) from {embeddings}) as vec
  from {part} where p_partkey % 50 = 1
) as picked
join {embeddings} on vec_id = vec
"""

SPEC = FeatureSpec(
    numeric=(
        "quantity",
        "price",
        "discount",
        "tax",
        "order_total",
        "retail_price",
        "size",
        "balance",
    ),
    categorical=("brand", "kind", "segment", "priority", "status", "page_type"),
    embedding_dim=64,
)
WHOLE_RANGE = SampleConfig(base_start="1990-01-01", base_stop="2010-01-01", hash_algo="md5")
MONTH = SampleConfig(stop_date="2000-01-31", finetune_window_days=30, hash_algo="md5")
ENCODING = PreprocessConfig(id_hash={"shop_id": (50, 16)}, hash_algo="md5", pretrained_emb_dim=64)


# Stated, so that opening a table does not start a job to read its footers.
SCHEMAS = {
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("lineitem", "orders", "part", "customer")
    return spark.sql(INTERACTIONS_SQL, **{n: table(spark, sf_dir, n) for n in names})


def embedding_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "embeddings")
    return spark.sql(HISTORY_SQL, **{n: table(spark, sf_dir, n) for n in names})


def product_embedding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("part", "embeddings")
    return spark.sql(PRODUCT_EMBEDDINGS_SQL, **{n: table(spark, sf_dir, n) for n in names})


# A small network for the scoring checks.  Its weights follow one rule, so that they can be
# restated anywhere: entry k of weight number s is ((37 k + 11 s) mod 41 - 20) / divisor.
NUM_EMB_DIM = 2
PROJECTED_DIM = 4
EXPERTS, RANK = 2, 3
CROSS_LAYERS = 2
DEEP_DIMS = (16, 8)
HEAD_DIMS = (6, 4)
SCORING = PreprocessConfig(
    n_bins=16,
    id_hash={"shop_id": (50, 2)},
    dim_overrides={c: 2 for c in SPEC.categorical},
    hash_algo="md5",
    pretrained_emb_dim=64,
    num_cross_layers=CROSS_LAYERS,
    deep_dims=DEEP_DIMS,
    head_dims=HEAD_DIMS,
)
CATEGORY_ORDER = tuple(sorted((*SPEC.categorical, "shop_id")))


def weight_layout(vocab_sizes: dict[str, int], with_embeddings: bool) -> list[tuple]:
    """``(name, shape, divisor, shift)`` of every weight; the position is its number."""
    dim = len(SPEC.numeric) * NUM_EMB_DIM + 2 * len(CATEGORY_ORDER)
    layout: list[tuple] = []

    def add(name: str, shape: tuple[int, ...], divisor: float = 100.0, shift: float = 0.0) -> None:
        layout.append((name, shape, divisor, shift))

    def add_norm(name: str, width: int) -> None:
        add(f"{name}.norm_weight", (width,), 100.0, 1.0)
        add(f"{name}.norm_bias", (width,))

    for source in ("product", "user"):
        add(f"{source}_proj.weight", (PROJECTED_DIM, SPEC.embedding_dim))
        add(f"{source}_proj.bias", (PROJECTED_DIM,))
        add_norm(f"{source}_proj", PROJECTED_DIM)
    if with_embeddings:
        dim += 2 * PROJECTED_DIM + 2
    for i in range(CROSS_LAYERS):
        add(f"cross.{i}.down", (EXPERTS, RANK, dim))
        add(f"cross.{i}.up", (EXPERTS, dim, RANK))
        add(f"cross.{i}.bias", (dim,))
        add(f"cross.{i}.gate", (EXPERTS, dim))

    def add_stack(name: str, dims: tuple[int, ...]) -> None:
        for i, (a, b) in enumerate(zip(dims, dims[1:])):
            if i < len(dims) - 2:
                add(f"{name}.{i}.gate", (b, a))
                add(f"{name}.{i}.value", (b, a))
                add(f"{name}.{i}.value_bias", (b,))
                add_norm(f"{name}.{i}", b)
            else:
                add(f"{name}.{i}.weight", (b, a))
                add(f"{name}.{i}.bias", (b,))

    add_stack("deep", (dim, *DEEP_DIMS))
    add_stack("head", (dim + DEEP_DIMS[-1], *HEAD_DIMS))
    add("logit.weight", (1, HEAD_DIMS[-1]), 4.0)
    add("logit.bias", (1,))
    add("numeric_emb", (len(SPEC.numeric) * (SCORING.n_bins + 1), NUM_EMB_DIM), 20.0)
    for c in CATEGORY_ORDER:
        add(f"cat_emb.{c}", (vocab_sizes.get(c, 0), 2), 20.0)
    return layout


def weight_table(
    spark: SparkSession, vocab_sizes: dict[str, int], with_embeddings: bool = True
) -> DataFrame:
    """The weights as the table that scoring reads: ``(name, shape, values)``.

    Made from Arrow: a list of rows would start a Python worker per core of every executor, which
    then stays beside those that score.
    """
    rows = []
    for s, (name, shape, divisor, shift) in enumerate(weight_layout(vocab_sizes, with_embeddings)):
        size = 1
        for n in shape:
            size *= n
        values = [shift + ((37 * k + 11 * s) % 41 - 20) / divisor for k in range(size)]
        rows.append((name, list(shape), values))
    kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.float64()))
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return spark.createDataFrame(pa.table(columns, names=["name", "shape", "values"]))


def model_shape(with_embeddings: bool = True) -> ModelShape:
    cfg = replace(SCORING, use_pretrained_embeddings=with_embeddings)
    return cfg.model_shape(CATEGORY_ORDER)
