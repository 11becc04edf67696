"""The same results as plain SQL for an independent engine, one statement per query.

Written from the definitions, without windows of the Spark plans in mind: quantiles from a
sorted list, vocabularies by rank, positions by row number, the network as list arithmetic.
"""

from __future__ import annotations

from rankframe import fixtures as fx
from rankframe.checks.farm_sql import fingerprint_bucket, fingerprint_ctes
from rankframe.checks.queries import BATCH_ROWS, MANY_CATEGORIES, N_BINS, USER_SAMPLE_PCT, WINDOW
from rankframe.spec import BUYER_HASH_MODULUS, MISSING_CATEGORY, resolve_window

_TABLES = {n: n for n in ("lineitem", "orders", "part", "customer", "embeddings")}
SPEC = fx.SPEC
KEYS = ", ".join(SPEC.keys)
# Results show nulls and NaN as ordinary values, like the queries do.
SHOWN = (
    "unified_buyer_id, coalesce(product_id, -1) as product_id, coalesce(shop_id, -1) as shop_id,"
    " event_timestamp_day"
)
SHOWN_SPLIT = """select * replace (coalesce(product_id, -1) as product_id,
  coalesce(shop_id, -1) as shop_id, coalesce(kind, '(null)') as kind,
  coalesce(discount, -1) as discount, case when isnan(tax) then -2 else tax end as tax) from split"""
DIM = SPEC.embedding_dim

INTERACTIONS = f"interactions as ({fx.INTERACTIONS_SQL.format(**_TABLES)})"
HISTORY = f"history as ({fx.HISTORY_SQL.format(**_TABLES)})"
PRODUCTS = f"products as ({fx.PRODUCT_EMBEDDINGS_SQL.format(**_TABLES)})"
ON_SURFACE = {
    "all": "page_type in ('home_feed', 'boosted_merchants') and section_id not like '%recently_viewed%'",
    "boosted_merchants": "page_type = 'boosted_merchants' and campaign_id is not null"
    " and section_id not like '%recently_viewed%'",
}


def bucket(text: str, n: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 15))::bigint % {n})"


BUYER_HASH = bucket("unified_buyer_id", BUYER_HASH_MODULUS)
TRIPLE = "unified_buyer_id || '|' || cast(product_id as varchar) || '|' || cast(event_timestamp_day as varchar)"


def user_key(hashed: str) -> str:
    days = "date_diff('day', date '1970-01-01', event_timestamp_day)"
    return f"(coalesce({hashed}, 0) * 100000 + coalesce({days}, 0))"


def _window(start, stop) -> str:
    return f"event_timestamp_day >= date '{start}' and event_timestamp_day < date '{stop}'"


def _threshold(scale: int) -> str:
    return f"cast(round({1_000_000 * scale} * pos_rate / (1.0::double - pos_rate)) as bigint)"


def _sampled(where: str, name: str = "kept") -> str:
    """CTEs: eligible rows, their positive rate, and the rows left after downsampling."""
    rate = "avg(case when is_native_order then 1.0::double else 0.0::double end)"
    return f"""eligible as (select * from interactions where {where}),
stats as (select {rate} as pos_rate from eligible),
{name} as (select eligible.* from eligible, stats
  where is_native_order or {bucket(TRIPLE, 1_000_000)} <= {_threshold(20)})"""


def _split(cfg, mode: str) -> str:
    columns = ", ".join(SPEC.split_columns)
    where = f"{_window(*resolve_window(cfg, mode))} and {ON_SURFACE[cfg.surface]}"
    return f"""{INTERACTIONS}, {_sampled(where)},
split as (select {columns}, case when is_native_order then 1 else 0 end as target_is_native_order,
  {BUYER_HASH} as ubi_hash from kept)"""


BASE = _split(fx.WHOLE_RANGE, "base_train")
MONTH = _split(fx.MONTH, "finetune")


def _clean(column: str) -> str:
    return f"cast(case when {column} is null or isnan({column}) then 0 else {column} end as float)"


def _prepared(source: str = "split", name: str = "prepared") -> str:
    numeric = ", ".join(f"{_clean(c)} as {c}" for c in SPEC.numeric)
    cats = ", ".join(f"coalesce({c}, '{MISSING_CATEGORY}') as {c}" for c in SPEC.categorical)
    return (
        f"{name} as (select {KEYS}, {numeric}, {cats}, ubi_hash, target_is_native_order from {source})"
    )


def _bounds(n_bins: int, source: str = "prepared") -> str:
    """CTE ``bounds(feature, pos, bound)`` from sorted lists, interpolated from the nearer side."""
    sorted_lists = " union all ".join(
        f"select '{c}' as feature, list_sort(list({c})) as vals, count(*) as n from {source}"
        for c in SPEC.numeric
    )
    return f"""sorted_values as ({sorted_lists}),
probes as (select feature, vals, n, j as pos, (cast(j as double) / {n_bins}) * (n - 1) as h
  from sorted_values, range(1, {n_bins}) t(j)),
ends as (select feature, pos, h - floor(h) as part, vals[cast(floor(h) as bigint) + 1] as low,
  vals[least(cast(floor(h) as bigint) + 2, n)] as high from probes),
bounds as (select feature, pos, cast(case
    when part >= 0.5 then high::double - (high - low)::double * (1 - part)
    else low::double + (high - low)::double * part end as float) as bound from ends)"""


def _bound_lists() -> str:
    lists = ", ".join(
        f"list(bound order by pos) filter (where feature = '{c}') as bl_{c}" for c in SPEC.numeric
    )
    return f"bound_lists as (select {lists} from bounds)"


def _bin(column: str) -> str:
    return f"(len(list_filter(bl_{column}, lambda b: b < {column})) + 1)::int"


def _vocab(source: str, name: str = "vocab", columns: tuple[str, ...] = SPEC.categorical) -> str:
    values = " union ".join(
        f"select '{c}' as feature, {c} as value from {source} where {c} is not null"
        for c in columns
    )
    return f"""{name} as (select feature, value,
  (row_number() over (partition by feature order by value))::int as id from ({values}))"""


def _code(column: str) -> str:
    return (
        f"coalesce((select id from vocab where feature = '{column}' and value = r.{column}), 0)::int"
    )


def _shop_code(buckets: int) -> str:
    token = "coalesce(cast(shop_id as varchar), chr(1) || 'null')"
    return f"({bucket(token, buckets)} + 1)::int"


def _cat_columns(buckets: int = 50) -> str:
    names = sorted((*SPEC.categorical, "shop_id"))
    return ", ".join(
        f"{_shop_code(buckets) if c == 'shop_id' else _code(c)} as cat_{c}" for c in names
    )


NUM_COLUMNS = ", ".join(f"{c}::double as num_{c}" for c in SPEC.numeric)
BIN_COLUMNS = ", ".join(f"{_bin(c)} as bin_{c}" for c in SPEC.numeric)
FITTED = f"{BASE}, {_prepared()}, {_bounds(N_BINS)}, {_bound_lists()}, {_vocab('prepared')}"


def _sums(vector: str, name: str) -> str:
    plain = f"list_transform({vector}, lambda x: x::double)"
    weighted = f"list_transform({vector}, lambda x, i: x::double * i)"
    return (
        f"round(list_sum({plain}), 6) + 0.0 as {name}_sum, "
        f"round(list_sum({weighted}), 6) + 0.0 as {name}_dot"
    )


ZEROS = f"list_transform(range({DIM}), lambda i: 0::float)"
PRODUCT_EXPORT = f"""product_export as (select product_id,
  product_search_document_embedding as vec from products
  where product_id in (select product_id from split where product_id is not null))"""


def _user_export(pairs_from: str) -> str:
    vector = "user_average_product_search_document_embedding"
    return f"""pairs as (select distinct unified_buyer_id, event_timestamp_day from {pairs_from}),
user_export as (select {user_key(bucket('p.unified_buyer_id', BUYER_HASH_MODULUS))} as user_date_key,
  coalesce(h.{vector}, {ZEROS}) as vec
  from pairs p join history h on h.unified_buyer_id = p.unified_buyer_id
    and h.interaction_type = 'ORDER'
    and h.valid_from <= cast(p.event_timestamp_day as timestamp)
    and (h.valid_to is null or h.valid_to > cast(p.event_timestamp_day as timestamp)))"""


def _lookups(rows: str) -> str:
    """CTE ``looked_up``: ``rows`` plus the smallest vector of each key, zeros if there is none."""
    return f"""best_product as (select product_id, min(vec) as vec from product_export group by 1),
best_user as (select user_date_key, min(vec) as vec from user_export group by 1),
looked_up as (select r.*, {user_key('ubi_hash')} as user_date_key,
  coalesce(bp.vec, {ZEROS}) as pvec, coalesce(bu.vec, {ZEROS}) as uvec
  from {rows} r
  left join best_product bp on bp.product_id = coalesce(r.product_id, 0)
  left join best_user bu on bu.user_date_key = {user_key('ubi_hash')})"""


EMBEDDED = f"{HISTORY}, {PRODUCTS}, {PRODUCT_EXPORT}, {_user_export('split')}"


# --- the small network as list arithmetic ------------------------------------------------------


class Network:
    """SQL expressions over CTE columns; every weight is spelt by its rule."""

    def __init__(self, with_embeddings: bool) -> None:
        self.with_embeddings = with_embeddings
        layout = fx.weight_layout({}, with_embeddings)
        self.slots = {name: (s, *rest) for s, (name, *rest) in enumerate(layout)}

    def entry(self, name: str, k: str) -> str:
        s, _, divisor, shift = self.slots[name]
        return f"({shift} + ((37 * ({k}) + {11 * s}) % 41 - 20)::double / {divisor})"

    def vector(self, name: str, offset: str = "0", n: int | None = None) -> str:
        n = self.slots[name][1][-1] if n is None else n
        return f"list_transform(range({n}), lambda j: {self.entry(name, f'{offset} + j')})"

    def matrix(self, name: str, rows: int | None = None, cols: int | None = None, base: int = 0) -> str:
        shape = self.slots[name][1]
        rows, cols = rows or shape[0], cols or shape[1]
        return (
            f"list_transform(range({rows}), lambda i: list_transform(range({cols}), "
            f"lambda j: {self.entry(name, f'{base} + i * {cols} + j')}))"
        )

    @staticmethod
    def product(matrix: str, x: str) -> str:
        return f"list_transform({matrix}, lambda row: list_dot_product(row, {x}))"

    @staticmethod
    def add(a: str, b: str) -> str:
        return f"list_transform({a}, lambda v, n: v + ({b})[n])"

    @staticmethod
    def times(a: str, b: str) -> str:
        return f"list_transform({a}, lambda v, n: v * ({b})[n])"

    def linear(self, weight: str, bias: str, x: str) -> str:
        return self.add(self.product(self.matrix(weight), x), self.vector(bias))

    def steps(self) -> Steps:
        return Steps(self)


class Steps:
    """Chain of CTEs, each adding columns to the one before."""

    def __init__(self, net: Network, start: str = "") -> None:
        self.net, self.ctes, self.last = net, [], start

    def put(self, **columns: str) -> None:
        name = f"step_{len(self.ctes)}"
        listed = ", ".join(f"{expr} as {c}" for c, expr in columns.items())
        self.ctes.append(f"{name} as materialized (select *, {listed} from {self.last})")
        self.last = name

    def normalize(self, x: str, name: str, out: str) -> None:
        self.put(**{f"{out}_m": f"list_avg({x})"})
        self.put(**{f"{out}_c": f"list_transform({x}, lambda v: v - {out}_m)"})
        self.put(
            **{
                f"{out}_s": f"sqrt(list_avg(list_transform({out}_c, lambda v: v * v)) + 1e-5)"
            }
        )
        scaled = f"list_transform({out}_c, lambda v: v / {out}_s)"
        n = self.net
        self.put(
            **{
                out: n.add(
                    n.times(scaled, n.vector(f"{name}.norm_weight")), n.vector(f"{name}.norm_bias")
                )
            }
        )

    def gelu(self, x: str, out: str) -> None:
        z = "(abs(v) / sqrt(2.0::double))"
        t = f"(1.0::double / (1.0 + 0.3275911::double * {z}))"
        poly = (
            f"({t} * (0.254829592::double + {t} * (-0.284496736::double + {t} * "
            f"(1.421413741::double + {t} * (-1.453152027::double + {t} * 1.061405429::double)))))"
        )
        erf = f"(sign(v) * (1.0 - {poly} * exp(-{z} * {z})))"
        self.put(**{out: f"list_transform({x}, lambda v: 0.5::double * v * (1.0 + {erf}))"})

    def project(self, vector: str, source: str, out: str) -> None:
        layer = f"{source}_proj"
        self.put(
            **{
                f"{out}_l": self.net.linear(
                    f"{layer}.weight", f"{layer}.bias", f"list_transform({vector}, lambda x: x::double)"
                )
            }
        )
        self.normalize(f"{out}_l", layer, f"{out}_n")
        self.gelu(f"{out}_n", out)

    def cross(self, x0: str, out: str) -> None:
        n = self.net
        x = x0
        for i in range(fx.CROSS_LAYERS):
            k, r, dim = n.slots[f"cross.{i}.down"][1]
            tag = f"cross_{i}"
            self.put(**{f"{tag}_g": n.product(n.matrix(f"cross.{i}.gate"), x)})
            self.put(**{f"{tag}_e": f"list_transform({tag}_g, lambda v: exp(v - list_max({tag}_g)))"})
            self.put(
                **{
                    f"{tag}_e{e}": n.product(
                        n.matrix(f"cross.{i}.up", dim, r, e * dim * r),
                        n.product(n.matrix(f"cross.{i}.down", r, dim, e * r * dim), x),
                    )
                    for e in range(k)
                }
            )
            mix = " + ".join(
                f"{tag}_e{e}[n] * {tag}_e[{e + 1}] / list_sum({tag}_e)" for e in range(k)
            )
            self.put(
                **{
                    tag: f"list_transform({x}, lambda v, n: {x0}[n] * ({mix} + "
                    f"{n.entry(f'cross.{i}.bias', 'n - 1')}) + v)"
                }
            )
            x = tag
        self.put(**{out: x})

    def stack(self, x: str, name: str, layers: int, out: str) -> None:
        n = self.net
        for i in range(layers - 1):
            tag = f"{out}_{i}"
            self.put(**{f"{tag}_g": n.product(n.matrix(f"{name}.{i}.gate"), x)})
            self.put(**{f"{tag}_v": n.linear(f"{name}.{i}.value", f"{name}.{i}.value_bias", x)})
            self.put(
                **{
                    f"{tag}_h": f"list_transform({tag}_v, lambda v, n: "
                    f"v * {tag}_g[n] / (1.0 + exp(-{tag}_g[n])))"
                }
            )
            self.normalize(f"{tag}_h", f"{name}.{i}", tag)
            x = tag
        last = layers - 1
        self.put(**{out: n.linear(f"{name}.{last}.weight", f"{name}.{last}.bias", x)})

    def score(self, limit_norms: bool) -> None:
        """Columns needed: ``bin_<numeric>``, ``cat_<name>``, and ``pp``/``up``/flags if used."""
        n = self.net
        width = fx.NUM_EMB_DIM
        parts = [
            n.vector(
                "numeric_emb",
                f"(bin_{c} + {i * (fx.SCORING.n_bins + 1)}) * {width}",
                width,
            )
            for i, c in enumerate(SPEC.numeric)
        ]
        cats = {
            f"ce_{c}": n.vector(f"cat_emb.{c}", f"cat_{c} * 2", 2) for c in fx.CATEGORY_ORDER
        }
        self.put(**cats)
        if limit_norms:
            self.put(
                **{
                    f"cl_{c}": f"list_transform(ce_{c}, lambda v: case when "
                    f"sqrt(list_dot_product(ce_{c}, ce_{c})) > 1 then "
                    f"v * (1.0 / (sqrt(list_dot_product(ce_{c}, ce_{c})) + 1e-7)) else v end)"
                    for c in fx.CATEGORY_ORDER
                }
            )
        parts += [f"{'cl' if limit_norms else 'ce'}_{c}" for c in fx.CATEGORY_ORDER]
        if n.with_embeddings:
            parts += ["pp", "up", "[has_product, has_user]"]
        joined = parts[0]
        for part in parts[1:]:
            joined = f"list_concat({joined}, {part})"
        self.put(x0=joined)
        self.cross("x0", "crossed")
        self.stack("x0", "deep", len(fx.DEEP_DIMS), "deep")
        self.put(combined="list_concat(crossed, deep)")
        self.stack("combined", "head", len(fx.HEAD_DIMS), "head")
        self.put(logit=f"({n.linear('logit.weight', 'logit.bias', 'head')})[1]")


def _flag(vector: str) -> str:
    return f"case when len(list_filter({vector}, lambda x: x <> 0)) > 0 then 1.0::double else 0.0::double end"


def _projection_query(ctes: str, source: str, key: str, table: str) -> str:
    steps = Steps(Network(True), f"(select {key}, vec from {table})")
    steps.project("vec", source, "proj")
    columns = ", ".join(
        f"round(proj[{i + 1}], 6) + 0.0 as proj_emb_{i}" for i in range(fx.PROJECTED_DIM)
    )
    return (
        f"with {ctes}, {', '.join(steps.ctes)} select {key}, {columns}, {_flag('vec')} as has_emb "
        f"from {steps.last}"
    )


def _score_query(raw: bool, with_embeddings: bool = True) -> str:
    encoded = f"""{BASE}, {_prepared()}, {_bounds(fx.SCORING.n_bins)}, {_bound_lists()},
{_vocab('prepared')},
encoded as (select r.*, {BIN_COLUMNS}, {_cat_columns()} from prepared r, bound_lists)"""
    steps = Steps(Network(with_embeddings))
    if with_embeddings:
        ctes = f"{encoded}, {EMBEDDED}, {_lookups('encoded')}"
        steps.last = "looked_up"
        steps.put(has_product=_flag("pvec"), has_user=_flag("uvec"))
        steps.project("pvec", "product", "pp")
        steps.project("uvec", "user", "up")
    else:
        ctes = encoded
        steps.last = "encoded"
    steps.score(limit_norms=raw)
    logit = "greatest(least(logit, 10.0), -10.0)" if raw else "logit"
    return f"with {ctes}, {', '.join(steps.ctes)} select {SHOWN}, round({logit}, 6) + 0.0 as score from {steps.last}"


def oracle_sql() -> dict[str, str]:
    encoded_all = f"""select {SHOWN}, {NUM_COLUMNS}, {BIN_COLUMNS}, {_cat_columns()}"""
    order = ", ".join(f"{c} nulls first" for c in (*SPEC.keys, "price"))
    bce = "(greatest(score, 0) - score * target + ln(1 + exp(-abs(score))))"
    sigmoid = "(1 / (1 + exp(-score)))"
    focal = (
        f"avg(case when target = 1 then 0.25 * power(1 - {sigmoid}, 2) "
        f"else 0.75 * power({sigmoid}, 2) end::double * {bce})"
    )
    penalty = "0.01::double * avg(score * score)"
    user_embeddings_asof = f"""with {INTERACTIONS}, {HISTORY}, {_user_export('interactions')}
        select user_date_key, {_sums('vec', 'emb')} from user_export"""
    negative_downsample = f"""with {INTERACTIONS}, {_sampled(ON_SURFACE['all'])}
        select {SHOWN}, is_native_order, price from kept"""
    warehouse_sample = f"""with {INTERACTIONS},
        {fingerprint_ctes('by_user', 'interactions', 'unified_buyer_id')},
        eligible as (select * exclude (fp), {fingerprint_bucket(BUYER_HASH_MODULUS)} as ubi_hash from by_user
          where {_window(*resolve_window(fx.WHOLE_RANGE, 'base_train'))} and {ON_SURFACE['all']}
          and {fingerprint_bucket(100)} < 60),
        stats as (select avg(case when is_native_order then 1.0::double else 0.0::double end) as pos_rate
          from eligible), {fingerprint_ctes('by_row', 'eligible', TRIPLE)}
        select {SHOWN}, is_native_order, ubi_hash, coalesce({fingerprint_bucket(1_000_000)}, -1) as row_hash
        from by_row, stats where is_native_order or {fingerprint_bucket(1_000_000)} <= {_threshold(20)}"""
    category_ids = f"""with {BASE}, {_vocab('split')} select {SHOWN},
        {', '.join(f'{_code(c)} as {c}_id' for c in SPEC.categorical)} from split r"""
    category_ids_many = f"""with {BASE}, many as (select *, product_id::varchar as product_text,
        unified_buyer_id as buyer_text, concat_ws('|', brand, segment) as pair_text from split),
        {_vocab('many', columns=MANY_CATEGORIES)} select {SHOWN},
        {', '.join(f'{_code(c)} as {c}_id' for c in MANY_CATEGORIES)} from many r"""
    embedding_lookup = f"""with {BASE}, {EMBEDDED}, {_lookups('split')}
        select {SHOWN}, user_date_key, {_sums('pvec', 'product')}, {_sums('uvec', 'user')},
        {_flag('pvec')} as has_product, {_flag('uvec')} as has_user from looked_up"""
    model_columns = f"{SHOWN}, {_cat_columns()}, {_sums('list_concat(pvec, uvec)', 'emb')}"
    month_export = PRODUCT_EXPORT.replace("from split", "from month_split")
    return {
        "split_scan_summary": f"""with {BASE} select count(*) as n_rows,
            {len(SPEC.split_columns) + 2} as n_cols,
            count(distinct product_id) as n_products,
            (select count(*) from (select distinct unified_buyer_id, event_timestamp_day from split))
              as n_buyer_days from split""",
        "split_roundtrip": f"""with {BASE} select {SHOWN}, target_is_native_order, ubi_hash,
            price, brand from split""",
        **{
            f"surface_window_{short}": f"""with {INTERACTIONS} select {SHOWN}, page_type, section_id,
                coalesce(campaign_id, -1) as campaign_id from interactions where {_window(*WINDOW)} and {ON_SURFACE[surface]}"""
            for short, surface in (("all", "all"), ("boosted", "boosted_merchants"))
        },
        "user_sample": f"""with {INTERACTIONS} select {SHOWN}, price from interactions
            where {bucket('unified_buyer_id', 100)} < {USER_SAMPLE_PCT}""",
        "positive_rate": f"""with {INTERACTIONS}, {_sampled(ON_SURFACE['all'])}
            select pos_rate, {_threshold(20)} as threshold from stats""",
        "negative_downsample": negative_downsample,
        "warehouse_sample": warehouse_sample,
        "one_scan_downsample": negative_downsample,
        "pointwise_base": f"with {BASE} {SHOWN_SPLIT}",
        "one_scan_split": f"with {BASE} {SHOWN_SPLIT}",
        "pointwise_finetune": f"with {MONTH} {SHOWN_SPLIT}",
        "day_rerun": f"with {MONTH} {SHOWN_SPLIT}",
        "distinct_products": f"""with {BASE} select distinct product_id from split
            where product_id is not null""",
        "distinct_buyer_days": f"""with {BASE}
            select distinct unified_buyer_id, event_timestamp_day from split""",
        "product_embeddings": f"""with {BASE}, {PRODUCTS}, {PRODUCT_EXPORT}
            select product_id, {_sums('vec', 'emb')} from product_export""",
        "user_embeddings_asof": user_embeddings_asof,
        "user_embeddings_in_blocks": user_embeddings_asof,
        "embedding_export": f"""with {BASE}, {EMBEDDED}
            select 'product' as source, product_id as id, {_sums('vec', 'emb')} from product_export
            union all
            select 'user' as source, user_date_key as id, {_sums('vec', 'emb')} from user_export""",
        "embedding_lookup": embedding_lookup,
        "embedding_lookup_shuffled": embedding_lookup,
        "embedding_lookup_bucketed": embedding_lookup,
        "clean_features": f"""with {BASE}, {_prepared()} select {SHOWN},
            {', '.join(f'{c}::double as {c}' for c in SPEC.numeric)}, {', '.join(SPEC.categorical)},
            target_is_native_order::double as target_is_native_order from prepared""",
        "quantile_boundaries": f"""with {BASE}, {_prepared()}, {_bounds(N_BINS)}
            select feature, pos::int as pos, bound::double as bound from bounds""",
        "boundaries_by_day_counts": f"""with {MONTH}, {_prepared()}, {_bounds(N_BINS)}
            select feature, pos::int as pos, bound::double as bound from bounds""",
        "window_fit_bins": f"""with {MONTH}, {_prepared()}, {_bounds(N_BINS)}, {_bound_lists()}
            select {SHOWN}, {BIN_COLUMNS} from prepared r, bound_lists""",
        "vocabulary": f"with {BASE}, {_prepared()}, {_vocab('prepared')} select * from vocab",
        "vocabulary_in_ranges": f"""with {INTERACTIONS} select 'triple' as feature, value,
            (row_number() over (order by value))::int as id from (select distinct
              concat_ws('|', unified_buyer_id, product_id, event_timestamp_day) as value from interactions)""",
        "vocab_sizes": f"""with {BASE}, {_vocab('split')} select feature, count(*) + 1 as vocab_size,
            least(50, greatest(1, (count(*) + 1) // 2))::int as emb_dim from vocab group by feature""",
        "quantile_bins": f"with {FITTED} select {SHOWN}, {BIN_COLUMNS} from prepared r, bound_lists",
        "category_ids": category_ids,
        "category_ids_shuffled": category_ids,
        "category_ids_many": category_ids_many,
        "hashed_ids": f"""with {INTERACTIONS} select {SHOWN}, {_shop_code(50)} as shop_code
            from interactions""",
        "full_transform": f"""with {FITTED} {encoded_all},
            target_is_native_order::double as target from prepared r, bound_lists""",
        "serving_transform": f"with {FITTED} {encoded_all} from prepared r, bound_lists",
        "published_transform": f"with {FITTED} {encoded_all} from prepared r, bound_lists",
        "train_serve_parity": f"""with {BASE} select count(*) as n_rows, 0::bigint as bin_mismatches,
            0::bigint as cat_mismatches from split""",
        "finetune_encode": f"""with {FITTED}, month_split as (
              with {MONTH} select * from split), {_prepared('month_split', 'month_rows')}
            {encoded_all}, target_is_native_order::double as target from month_rows r, bound_lists""",
        "model_ready": f"""with {FITTED}, {EMBEDDED}, {_lookups('prepared')}
            select {SHOWN}, {_cat_columns()}, target_is_native_order::double as target,
            {_sums('list_concat(pvec, uvec)', 'emb')} from looked_up r""",
        "wide_embeddings_packed": f"""with {BASE}, {PRODUCTS}, best as (select product_id,
              min(product_search_document_embedding) as vec from products group by 1),
            wide as (select s.*, coalesce(vec, {ZEROS}) as v from split s left join best using (product_id)),
            packed as (select *, list_concat(v, list_transform(list_reverse(v), lambda x: x * 2)) as emb
              from wide)
            select {SHOWN}, len(emb)::int as width, {_sums('emb', 'emb')} from packed""",
        "two_exports_one_root": f"""with {FITTED}, {EMBEDDED}, {_lookups('prepared')},
            month_split as (with {MONTH} select * from split), {_prepared('month_split', 'month_rows')},
            month_looked as (with {month_export}, {_user_export('month_split')}, {_lookups('month_rows')}
              select * from looked_up)
            select 'base_train' as split, {model_columns} from looked_up r
            union all select 'finetune' as split, {model_columns} from month_looked r""",
        "training_batches": f"""with {BASE}, numbered as (select {KEYS}, price,
              row_number() over (order by {order}) - 1 as pos from split)
            select {SHOWN}, price, pos, pos // {BATCH_ROWS} as batch_id from numbered""",
        "shuffled_batches": f"""with {BASE}, total as (select count(*) as n,
              sum(coalesce({bucket(TRIPLE, 1_000_000)}, 0) + target_is_native_order)::bigint as row_sum from split)
            select b as batch_id, least(n - b * {BATCH_ROWS}, {BATCH_ROWS}) as n_rows,
            b * {BATCH_ROWS} as first_pos, least(n, (b + 1) * {BATCH_ROWS}) - 1 as last_pos, row_sum
            from total, range((n + {BATCH_ROWS - 1}) // {BATCH_ROWS}) t(b)""",
        "focal_loss": f"""with {INTERACTIONS}, scored as (select (quantity - 25.0) / 8.0 as score,
              case when is_native_order then 1 else 0 end as target from interactions)
            select count(*) as n_rows, round({focal}, 9) as focal_loss,
            round({penalty}, 9) as logit_penalty, round({focal} + {penalty}, 9) as total_loss,
            round(avg({bce}) / 2, 9) as half_bce from scored""",
        "score_parity": """with a as (select o_orderkey, o_totalprice / 100000 as low,
              case when o_orderkey % 7 = 0 then 1 else 0 end as more from orders),
            b as (select l_orderkey as o_orderkey, max(l_extendedprice) / 100000 as score
              from lineitem group by 1)
            select count_if(a.o_orderkey is not null and b.o_orderkey is not null)::bigint as n_matched,
            count_if(a.o_orderkey is null or b.o_orderkey is null)::bigint as n_unmatched,
            count_if(more = 1)::bigint as n_repeated,
            round(max(greatest(low + more - score, score - low)), 9) as max_abs_diff,
            round(avg(abs((low + low + more) / 2 - score)), 9) as mean_abs_diff, false as passed
            from a full join b using (o_orderkey)""",
        "preproject_products": _projection_query(
            f"{PRODUCTS}, product_vectors as (select product_id, product_search_document_embedding"
            " as vec from products)",
            "product",
            "product_id",
            "product_vectors",
        ),
        "projections_in_increments": _projection_query(
            f"{PRODUCTS}, product_vectors as (select product_id, min(product_search_document_embedding)"
            " as vec from products where product_id is not null group by 1)",
            "product",
            "product_id",
            "product_vectors",
        ),
        "preproject_users": _projection_query(
            f"{BASE}, {HISTORY}, {_user_export('split')}", "user", "user_date_key", "user_export"
        ),
        "score_rows": _score_query(raw=True),
        "score_projected": _score_query(raw=False),
        "scoring_paths_agree": f"""with {BASE}, ids as (select {KEYS}, count(*) as n from split group by all)
            select count(*)::bigint as n_matched, 0::bigint as n_unmatched,
            count_if(n > 1)::bigint as n_repeated, true as passed from ids""",
        "score_without_embeddings": _score_query(raw=False, with_embeddings=False),
    }
