"""DuckDB statements for the registered queries, written from the definitions.

Shared steps are common table expressions; each statement takes the ones it
needs. Labels, bins and rule conditions are the parameters of the queries.
"""

from __future__ import annotations

from itertools import combinations

from cartwright import names as N
from checks import spec

RUN, START, CUTOFF, REFERENCE = "2001-06-01", "1995-06-01", "1996-01-01", "2001-05-31"
BRANDS = [f"Brand#{i}" for i in range(1, 25)]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
BASE_COLS = {b: "categ_base_product_" + b.lower().replace("#", "_") for b in BRANDS}
TYPE_COLS = {t: "dri_categ_" + t.lower() for t in TYPES}
CATEGORY_COLS = [*BASE_COLS.values(), *TYPE_COLS.values()]
BUCKETS = list(zip(N.BUCKET_LABELS, N.PRICE_BINS, N.PRICE_BINS[1:]))
BUCKET_COLS = [f"{b}_items_count" for b in N.BUCKET_LABELS]
WINDOW = f"placed >= TIMESTAMP '{START}' AND placed < TIMESTAMP '{RUN}'"


def q(name: str) -> str:
    return f'"{name}"'


def r6(expr: str) -> str:
    return f"round({expr} + 3e-9, 6)"


def daypart(ts: str) -> str:
    return (
        f"CASE WHEN hour({ts}) BETWEEN 6 AND 10 THEN 'Breakfast' WHEN hour({ts}) BETWEEN 11 AND 14 THEN 'Lunch' "
        f"WHEN hour({ts}) BETWEEN 15 AND 18 THEN 'Evening' WHEN hour({ts}) >= 19 THEN 'Dinner' ELSE 'Late Night' END"
    )


def weekend(ts: str) -> str:
    return f"CAST(isodow({ts}) >= 6 AS INTEGER)"


def bucket(price: str) -> str:
    whens = " ".join(f"WHEN {price} >= {lo} AND {price} < {hi} THEN '{b}'" for b, lo, hi in BUCKETS)
    return f"CASE {whens} END"


CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, *needs: str, sql: str) -> None:
    CTE[name] = (needs, sql)


cte("o", sql="""
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS user_id,
  CAST(o_custkey % 26 AS INTEGER) AS store_id,
  CASE WHEN o_orderkey % 10 <= 7 THEN 'ownapp' WHEN o_orderkey % 10 = 8 THEN 'swiggy' ELSE 'instore' END AS channel,
  CASE WHEN o_orderkey % 37 <> 0 THEN
    CAST(CASE WHEN o_custkey % 10 = 0 THEN o_custkey - o_custkey % 30 ELSE o_custkey END AS VARCHAR) END AS cust,
  o_orderdate + to_hours(CAST((o_orderkey * 7) % 24 AS INTEGER)) AS placed_utc,
  o_orderdate + to_hours(CAST((o_orderkey * 7) % 24 AS INTEGER)) + to_minutes(CAST(20 + o_orderkey % 41 AS INTEGER)) AS delivered_utc,
  o_orderdate + to_hours(CAST((o_orderkey * 7) % 24 AS INTEGER)) + INTERVAL 330 MINUTE AS placed,
  o_orderdate + to_hours(CAST((o_orderkey * 7) % 24 AS INTEGER)) + to_minutes(CAST(20 + o_orderkey % 41 AS INTEGER)) + INTERVAL 330 MINUTE AS delivered,
  CASE WHEN o_orderkey % 97 = 0 THEN 0.0::DOUBLE WHEN o_orderkey % 89 = 0 THEN -1.0::DOUBLE
    ELSE o_totalprice * (o_orderkey % 11) / 100 END AS discounted_price,
  CASE WHEN o_orderkey % 97 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS sub_total_price,
  o_totalprice AS total_price, o_orderpriority AS platform, o_orderstatus AS status_id,
  (o_orderstatus = 'F' AND o_orderkey % 5 = 0) AS has_query
FROM orders""")

cte("li", sql="""
SELECT l_orderkey AS sales_id, CAST(l_partkey AS VARCHAR) AS item_id_id, CAST(l_quantity AS INTEGER) AS quantity,
  l_extendedprice / 100 AS original_price, l_returnflag = 'R' AS promo_item,
  l_returnflag = 'A' AS is_customized, l_linestatus = 'O' AS is_veg, l_orderkey % 10 = 9 AS instore
FROM lineitem""")

cte("cat", sql="""
SELECT CAST(p_partkey AS VARCHAR) AS item_id_id, 'P' || p_partkey AS ProductCode,
  CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_brand = 'Brand#25' THEN ' Exclude ' ELSE p_brand END AS base_label,
  CASE WHEN p_partkey % 23 <> 0 THEN p_type END AS dri_label
FROM part""")

cte("combo", sql="""
SELECT DISTINCT CAST(a.l_partkey AS VARCHAR) AS h, CAST(b.l_partkey AS VARCHAR) AS c, 25 AS qty
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey
WHERE a.l_linenumber = 1 AND b.l_linenumber = 2""")

cte("store", sql="""
SELECT n_nationkey AS code, 'Store ' || n_name AS store_name, r_name AS store_type, n_name AS city,
  'G' || n_regionkey AS generator FROM nation JOIN region ON n_regionkey = r_regionkey""")


def removal(prefix: str, payable: str) -> None:
    cte(f"{prefix}_pair", "li", sql=f"""
SELECT sales_id, item_id_id, count(*) AS choice_count, CAST(sum(quantity) AS BIGINT) AS order_quantity
FROM li WHERE {payable} GROUP BY ALL""")
    cte(f"{prefix}_removed", f"{prefix}_pair", "combo", sql=f"""
SELECT DISTINCT p.sales_id, p.item_id_id
FROM {prefix}_pair hp JOIN combo ON combo.h = hp.item_id_id
JOIN {prefix}_pair p ON p.sales_id = hp.sales_id AND p.item_id_id = combo.c
WHERE combo.qty >= p.order_quantity""")


removal("dlv", "NOT promo_item")
removal("ins", "true")
removal("mix", "(instore OR NOT promo_item)")

# cleaned lines as the row-grain operators see them: no choice removal
cte("clean", "li", "cat", sql="""
SELECT li.*, trim(base_label) AS base, dri_label AS dri FROM li JOIN cat USING (item_id_id)
WHERE NOT promo_item AND dri_label IS NOT NULL AND (base_label IS NULL OR trim(base_label) <> 'Exclude')""")

# cleaned lines of the order features: choice pairs removed, promo only where known
PAYABLE = {"dlv": "NOT promo_item", "ins": "true", "mix": "(instore OR NOT promo_item)"}
for form, payable in PAYABLE.items():
    cte(f"{form}_kept", "li", "cat", f"{form}_removed", sql=f"""
SELECT li.*, trim(base_label) AS base, dri_label AS dri FROM li JOIN cat USING (item_id_id)
WHERE {payable} AND dri_label IS NOT NULL AND (base_label IS NULL OR trim(base_label) <> 'Exclude')
  AND NOT EXISTS (SELECT 1 FROM {form}_removed m WHERE m.sales_id = li.sales_id AND m.item_id_id = li.item_id_id)""")


def presence(values: dict[str, str], column: str) -> str:
    return ",\n  ".join(
        f"CAST(coalesce(max(CASE WHEN {column} = '{v}' THEN 1 END), 0) AS INTEGER) AS {q(c)}" for v, c in values.items()
    )


def bucket_presence() -> str:
    return ",\n  ".join(
        f"CAST(coalesce(max(CASE WHEN original_price >= {lo} AND original_price < {hi} THEN 1 END), 0) AS INTEGER) AS {q(b + '_items_count')}"
        for b, lo, hi in BUCKETS
    )


def label_list(column: str) -> str:
    return f"coalesce(list_sort(list_distinct(list({column}) FILTER (WHERE {column} IS NOT NULL))), [])"


for form in PAYABLE:
    cte(f"{form}_kept_order", f"{form}_kept", sql=f"""
SELECT sales_id, {bucket_presence()}, {presence(TYPE_COLS, 'dri')}, {presence(BASE_COLS, 'base')},
  {label_list('dri')} AS {N.DRI_LIST}, {label_list('base')} AS {N.BASE_LIST}
FROM {form}_kept GROUP BY sales_id""")

cte("raw_order", "li", sql="""
SELECT sales_id, bool_or(is_customized) AS customization_flag, CAST(min(CAST(is_veg AS INTEGER)) AS INTEGER) AS veg_indicator,
  CAST(sum(quantity) AS BIGINT) AS item_count, CAST(sum(CAST(is_veg AS INTEGER)) AS BIGINT) AS veg_count,
  CAST(coalesce(sum(quantity) FILTER (WHERE promo_item), 0) AS BIGINT) AS promo_items
FROM li GROUP BY sales_id""")

cte("users", "o", sql=f"SELECT DISTINCT cust FROM o WHERE channel = 'ownapp' AND cust IS NOT NULL AND {WINDOW}")

FLAG_COLS = [*BUCKET_COLS, *CATEGORY_COLS]
# mix: each order in the form of its channel; dlv, agg and ins: every order in that form
FORMS = {
    "feat": ("mix", """(o.channel = 'ownapp' OR o.cust IN (SELECT cust FROM users))
  AND (o.channel <> 'instore' OR o.store_id <> 13)"""),
    "dlv_feat": ("dlv", "true"),
    "agg_feat": ("dlv", "o.cust IN (SELECT cust FROM users)"),
    "ins_feat": ("ins", "o.cust IN (SELECT cust FROM users) AND o.store_id <> 13"),
}
for feature_set, (form, wanted) in FORMS.items():
    cte(feature_set, "o", "users", "raw_order", f"{form}_kept_order", "store", sql=f"""
SELECT o.*, {daypart('placed')} AS order_time_of_day, {weekend('placed')} AS is_weekend,
  r.customization_flag, r.veg_indicator, r.item_count, r.veg_count, coalesce(r.promo_items, 0) AS promo_items,
  {', '.join('k.' + q(c) for c in FLAG_COLS)}, k.{N.DRI_LIST}, k.{N.BASE_LIST},
  s.store_type, s.generator, s.city
FROM o LEFT JOIN raw_order r ON r.sales_id = o.id LEFT JOIN {form}_kept_order k ON k.sales_id = o.id
LEFT JOIN store s ON s.code = o.store_id
WHERE o.cust IS NOT NULL AND {WINDOW} AND {wanted}""")

# unified orders of the customer stage
cte("u", "feat", sql=f"""
SELECT feat.*, CASE WHEN channel = 'instore' THEN total_price + discounted_price
  ELSE discounted_price + sub_total_price END AS price_without_taxes
FROM feat WHERE placed >= TIMESTAMP '{CUTOFF}'""")


def days(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us({b}) - epoch_us({a})) / 86400000000.0) AS BIGINT)"


def scoped(prefix: str, col: str) -> str:
    where = "" if prefix == "omnichannel" else " FILTER (WHERE channel = 'ownapp')"
    return f"CAST(coalesce(sum({q(col)}){where}, 0) AS BIGINT)"


PREFIXES = ("omnichannel", "ownapp")
DAYPART_COLS = {p: {d: f"{p}_{d}_order_count" for d in N.DAYPARTS} for p in PREFIXES}


def daypart_aggs() -> list[str]:
    out = []
    for p in PREFIXES:
        extra = "" if p == "omnichannel" else " AND channel = 'ownapp'"
        out += [f"count(*) FILTER (WHERE order_time_of_day = '{d}'{extra}) AS {q(c)}" for d, c in DAYPART_COLS[p].items()]
    return out


def combo_cols() -> dict[str, str]:
    out = {}
    for p in PREFIXES:
        for size in range(2, 6):
            for combo in combinations(N.DAYPARTS, size):
                out[f"{p}_{'_'.join(combo)}_order_count"] = "CAST(" + " + ".join(q(DAYPART_COLS[p][d]) for d in combo) + " AS BIGINT)"
    return out


def bucket_order_cols() -> dict[str, str]:
    return {
        f"{p}_order_count_with_{b}_price_range_items": scoped(p, f"{b}_items_count")
        for p in PREFIXES for b in N.BUCKET_LABELS
    }


def category_order_cols() -> dict[str, str]:
    return {f"{p}_{c}_count": scoped(p, c) for p in PREFIXES for c in CATEGORY_COLS}


SUMS = {**bucket_order_cols(), **category_order_cols()}
cte("agg", "u", sql=f"""
SELECT cust AS algonomy_id, count(*) AS omnichannel_order_count,
  count(*) FILTER (WHERE channel = 'ownapp') AS ownapp_order_count,
  count(*) FILTER (WHERE channel = 'swiggy') AS swiggy_order_count,
  count(*) FILTER (WHERE channel = 'instore') AS instore_order_count,
  CAST(sum(is_weekend) AS BIGINT) AS weekend,
  avg(CASE WHEN price_without_taxes <> 0 THEN discounted_price / price_without_taxes END) AS pct,
  avg(total_price) AS aov, avg(discounted_price) AS avg_discount,
  min(placed) AS omnichannel_first_order_at, max(placed) AS omnichannel_last_order_at,
  min(placed) FILTER (WHERE channel = 'ownapp') AS ownapp_first_order_at,
  max(placed) FILTER (WHERE channel = 'ownapp') AS ownapp_last_order_at,
  avg((epoch_us(delivered) - epoch_us(placed)) / 60000000.0) FILTER (WHERE channel = 'ownapp') AS minutes,
  list_sort(list_distinct(flatten(list(coalesce({N.DRI_LIST}, []))))) AS {N.DRI_LIST},
  list_sort(list_distinct(flatten(list(coalesce({N.BASE_LIST}, []))))) AS {N.BASE_LIST},
  {', '.join(daypart_aggs())},
  {', '.join(f'{e} AS {q(n)}' for n, e in SUMS.items())}
FROM u GROUP BY cust HAVING count(*) FILTER (WHERE channel = 'ownapp') > 0""")


def date_cols(p: str) -> str:
    first, last = f"{p}_first_order_at", f"{p}_last_order_at"
    tenure = f"({days(first, last)} + 1)"
    return (
        f"{days(last, f'TIMESTAMP {chr(39)}{REFERENCE}{chr(39)}')} AS {p}_recency, {tenure} AS {p}_tenure_days, "
        + r6(f"CASE WHEN {p}_order_count > 1 THEN {tenure}::DOUBLE / ({p}_order_count - 1) END")
        + f" AS {p}_avg_days_between_orders"
    )


LABEL = """CASE WHEN swiggy_order_count = 0 AND instore_order_count = 0 THEN 'OC only'
  ELSE 'OC' || CASE WHEN instore_order_count > 0 THEN ' + Dine in' ELSE '' END
    || CASE WHEN swiggy_order_count > 0 THEN ' + Swiggy' ELSE '' END END AS channels_ordered_from"""
CHANNEL_COUNT = """CAST((ownapp_order_count > 0)::INTEGER + (swiggy_order_count > 0)::INTEGER
  + (instore_order_count > 0)::INTEGER AS INTEGER) AS channel_count"""
PCT = r6("CASE WHEN pct < 0 THEN 0.0 ELSE pct END") + " AS omnichannel_avg_discount_pct"
BASE_COUNT = f"CAST(len({N.BASE_LIST}) AS BIGINT) AS unique_category_base_products_count"
DRI_COUNT = f"CAST(len({N.DRI_LIST}) AS BIGINT) AS unique_dri_category_count"
WEEK = """weekend AS omnichannel_weekend_order_count,
  omnichannel_order_count - weekend AS omnichannel_weekday_order_count"""
ORDER_COUNTS = "ownapp_order_count, swiggy_order_count, instore_order_count, omnichannel_order_count"
MEANS = f"{r6('aov')} AS omnichannel_aov, {r6('avg_discount')} AS omnichannel_avg_discount"
TIMES = "omnichannel_first_order_at, omnichannel_last_order_at, ownapp_first_order_at, ownapp_last_order_at"
MINUTES = f"{r6('minutes')} AS ownapp_avg_delivery_time_minutes"
DAYPARTS = ", ".join(q(c) for p in PREFIXES for c in DAYPART_COLS[p].values())
COMBOS = ", ".join(f"{e} AS {q(n)}" for n, e in combo_cols().items())

cte("cust", "agg", sql=f"""
SELECT algonomy_id, {PCT}, {N.BASE_LIST}, {BASE_COUNT}, {N.DRI_LIST}, {DRI_COUNT}, {ORDER_COUNTS}, {WEEK},
  {MEANS}, {TIMES}, {LABEL}, {date_cols('omnichannel')}, {date_cols('ownapp')}, {CHANNEL_COUNT},
  {DAYPARTS}, {COMBOS}, {', '.join(q(n) for n in SUMS)}, {MINUTES}
FROM agg""")

# segmentation
cte("base", "cust", sql=f"""
SELECT {', '.join(q(c) for c in (*spec.KEEP, *spec.FLAGS))} FROM cust
WHERE ownapp_order_count <= 100 AND unique_dri_category_count IS DISTINCT FROM 0""")


def flag(col: str) -> str:
    return f"CAST(coalesce({q(col)} > 0, false) AS INTEGER)"


# names the rules use -> count column behind them
RULE_FLAGS = {
    "Weekend_flag": "omnichannel_weekend_order_count",
    "Weekday_flag": "omnichannel_weekday_order_count",
    "Premium_price_flag": "omnichannel_order_count_with_Premium_price_range_items",
    "Lunch_flag": "omnichannel_Lunch_order_count",
    "Late_Night_flag": "omnichannel_Late Night_order_count",
    "Breakfast_flag": "omnichannel_Breakfast_order_count",
    "Evening_flag": "omnichannel_Evening_order_count",
}


# The rules as the trees they come from, written out for this file: numbers count the segments below.
SEGMENTS = [f"Seg1_5_{i}" for i in range(1, 9)] + [f"Seg_6_15_{i:02}" for i in range(1, 11)] + [f"Seg15_plus_{i}" for i in range(1, 10)]
RANK_BAND = ["1_5"] * 8 + ["6_15"] * 10 + ["15_plus"] * 9
RANK = """CASE
  WHEN ownapp_order_count < 6 THEN CASE
    WHEN u <= 2.5 THEN CASE WHEN Weekend_flag = 0 THEN 0 WHEN Weekend_flag = 1 THEN
      CASE WHEN Weekday_flag = 0 THEN 1 WHEN Weekday_flag = 1 THEN 2 END END
    WHEN u > 2.5 THEN CASE
      WHEN channel_count <= 1.5 THEN CASE WHEN Weekday_flag = 0 THEN 3 WHEN Weekday_flag = 1 THEN 4 END
      WHEN channel_count > 1.5 THEN CASE WHEN Premium_price_flag = 1 THEN 5 WHEN Premium_price_flag = 0 THEN
        CASE WHEN Weekend_flag = 0 THEN 6 WHEN Weekend_flag = 1 THEN 7 END END END END
  WHEN ownapp_order_count BETWEEN 6 AND 15 THEN CASE
    WHEN u <= 6.5 THEN CASE WHEN Weekend_flag = 0 THEN 8 WHEN Weekend_flag = 1 THEN
      CASE WHEN Lunch_flag = 0 THEN 9 WHEN Lunch_flag = 1 THEN 10 END END
    WHEN u > 6.5 THEN CASE
      WHEN Premium_price_flag = 0 THEN CASE WHEN Lunch_flag = 0 THEN 11 WHEN Lunch_flag = 1 THEN
        CASE WHEN Late_Night_flag = 0 THEN 12 WHEN Late_Night_flag = 1 THEN 13 END END
      WHEN Premium_price_flag = 1 THEN CASE
        WHEN channel_count <= 1.5 THEN CASE WHEN Lunch_flag = 0 THEN 14 WHEN Lunch_flag = 1 THEN 15 END
        WHEN channel_count > 1.5 THEN CASE WHEN Late_Night_flag = 0 THEN 16 WHEN Late_Night_flag = 1 THEN 17 END END END END
  WHEN ownapp_order_count > 15 THEN CASE
    WHEN u <= 11.5 THEN CASE WHEN Breakfast_flag = 1 THEN 22 WHEN Breakfast_flag = 0 THEN CASE
      WHEN Late_Night_flag = 0 THEN 18 WHEN Late_Night_flag = 1 THEN
        CASE WHEN Evening_flag = 0 THEN 19 WHEN Evening_flag = 1 THEN CASE WHEN u > 8.5 THEN 20 ELSE 21 END END END END
    WHEN u > 11.5 THEN CASE WHEN Breakfast_flag = 1 THEN 26 WHEN Breakfast_flag = 0 THEN CASE
      WHEN Late_Night_flag = 1 THEN 25 WHEN Late_Night_flag = 0 THEN CASE WHEN u <= 16.5 THEN 23 ELSE 24 END END END END
END"""


def rank_case() -> str:
    return RANK.replace("u ", "unique_cat_base_count ")



def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def name_of(rank: str) -> str:
    return f"list_extract({sql_list(SEGMENTS)}, {rank} + 1)"


cte("flagged", "base", sql=f"""
SELECT *, unique_category_base_products_count AS unique_cat_base_count,
  {', '.join(f'{flag(src)} AS {q(name)}' for name, src in RULE_FLAGS.items())} FROM base""")
cte("ranked", "flagged", sql=f"SELECT *, {rank_case()} AS rnk FROM flagged")
cte("seg", "ranked", sql=f"""
SELECT {', '.join(q(c) for c in (*spec.KEEP, *spec.FLAGS))}, {name_of('rnk')} AS Segment FROM ranked""")

cte("grid", sql="""
SELECT CAST(l_suppkey AS VARCHAR) AS algonomy_id,
  CAST(list_extract([1,5,6,15,16,100], l_orderkey % 6 + 1) AS BIGINT) AS ownapp_order_count,
  CAST(list_extract([0,2,3,6,7,8,9,11,12,16,17], l_partkey % 11 + 1) AS BIGINT) AS unique_cat_base_count,
  CAST(1 + l_suppkey % 2 AS INTEGER) AS channel_count,
  CAST(l_linenumber % 2 AS INTEGER) AS Weekend_flag, CAST(CAST(l_quantity AS INTEGER) % 2 AS INTEGER) AS Weekday_flag,
  CAST(l_returnflag = 'A' AS INTEGER) AS Premium_price_flag, CAST(l_linestatus = 'O' AS INTEGER) AS Lunch_flag,
  CAST(CAST(round(l_discount * 100) AS INTEGER) % 2 AS INTEGER) AS Late_Night_flag,
  CAST(CAST(round(l_tax * 100) AS INTEGER) % 2 AS INTEGER) AS Breakfast_flag,
  CAST((l_partkey // 11) % 2 AS INTEGER) AS Evening_flag
FROM lineitem""")
cte("grid_ranked", "grid", sql=f"SELECT *, {rank_case()} AS rnk FROM grid")


# micro-segments
def plan_rows() -> str:
    rows = [f"('{seg}', '{name}')" for name, segs, _ in spec.PLAN_SOURCES for seg in segs]
    return f"(VALUES {', '.join(rows)}) AS plan(seg, plan)"


CAPPED_PLANS = ["Seg1_5_6", "Seg_6_15_10", "Seg15_plus_9"]


def model_column(feature: str) -> str:
    """Base column behind a model feature."""
    for c in (*spec.KEEP, *spec.FLAGS):
        short = c.removeprefix("omnichannel_")
        if spec.MICRO_RENAMES.get(short, short) == feature:
            return c
    raise KeyError(feature)


CAP_COLS = [c for c in map(model_column, spec.MODEL_FEATURES) if c != N.TARGET]
cte("planned", "seg", sql=f"SELECT seg.* EXCLUDE (Segment), plan FROM seg JOIN {plan_rows()} ON seg.Segment = plan.seg")
cte("bounds", "planned", sql=f"""
SELECT plan, {', '.join(f'quantile_cont({q(c)}::DOUBLE, 0.01) AS {q("lo_" + c)}, quantile_cont({q(c)}::DOUBLE, 0.99) AS {q("hi_" + c)}' for c in CAP_COLS)}
FROM planned WHERE plan IN ({', '.join(f"'{p}'" for p in CAPPED_PLANS)}) GROUP BY plan""")


def vector() -> str:
    parts = []
    for c in map(model_column, spec.MODEL_FEATURES):
        col = f"p.{q(c)}::DOUBLE"
        if c in CAP_COLS:
            col = f"CASE WHEN b.plan IS NULL THEN {col} ELSE least(greatest({col}, b.{q('lo_' + c)}), b.{q('hi_' + c)}) END"
        parts.append(col)
    return "[" + ", ".join(parts) + "]"


def distances(vec: str, model) -> str:
    terms = []
    for center in model.centers:
        parts = [
            f"(({vec}[{j + 1}] - {m}) / {s} - ({c})) * (({vec}[{j + 1}] - {m}) / {s} - ({c}))"
            for j, (m, s, c) in enumerate(zip(model.mean, model.scale, center))
        ]
        terms.append(" + ".join(parts))
    return "[" + ", ".join(terms) + "]"


def label(dist: str) -> str:
    return f"CAST(list_position({dist}, list_min({dist})) - 1 AS VARCHAR)"


cte("vec", "planned", "bounds", sql=f"""
SELECT p.*, {vector()} AS v FROM planned p LEFT JOIN bounds b ON p.plan = b.plan""")
DIST = "CASE " + " ".join(
    f"WHEN plan = '{p.name}' THEN {distances('v', spec.MODELS[p.model_key])}" for p in spec.PLANS
) + " END"
cte("dist", "vec", sql=f"SELECT * EXCLUDE (v), {DIST} AS d FROM vec")
cte("micro", "dist", sql=f"SELECT * EXCLUDE (d, plan), {label('d')} AS microcluster, plan AS Segment FROM dist")


def order_feature_columns(instore: bool, has_query: str = "has_query") -> str:
    tail = f"""{', '.join(q(c) for c in FLAG_COLS)}, {N.DRI_LIST}, {N.BASE_LIST}, order_time_of_day, is_weekend"""
    if instore:
        return f"""id AS order_id, placed AS order_placed_datetime, placed AS BussTime, store_id AS StoreCode, total_price,
  discounted_price, total_price AS BaseAmount, platform AS TransType, cust AS algonomy_id, status_id AS SaleType,
  store_type, generator AS store_generator_new, city AS store_geographical_city, city AS store_key_city, item_count, {tail}"""
    return f"""{delivery_base(has_query)}, customization_flag, veg_indicator, item_count, veg_count,
  CAST(promo_items AS BIGINT) AS promo_items, {tail}"""


def delivery_base(has_query: str) -> str:
    return f"""id AS order_id, user_id, platform AS device_type_platform, placed AS order_placed_datetime, channel AS order_channel,
  store_id AS store_mds_id, delivered AS actual_delivery_time, total_price AS pre_discount_order_value, discounted_price,
  total_price, total_price AS gross_price, sub_total_price, placed AS schedule_datetime, status_id, platform,
  delivered AS order_delivery_datetime, cust AS algonomy_id, store_type, generator AS store_generator_new,
  city AS store_geographical_city, city AS store_key_city, ({has_query}) AS has_query"""


QUERIES: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, *needs: str, sql: str) -> None:
    QUERIES[name] = (needs, sql)


query("scan_orders", sql="SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderstatus FROM orders")
query("scan_order_items", sql="""SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, l_quantity, l_extendedprice,
  l_returnflag, l_linestatus FROM lineitem""")
query("scan_instore_csv", "o", sql="""SELECT id AS InvoiceNo, placed AS BussTime, CAST(store_id AS BIGINT) AS StoreCode,
  total_price AS GrossAmount, discounted_price AS Discount, total_price AS BaseAmount, platform AS TransType, status_id AS SaleType FROM o""")
query("scan_instore_items_csv", "o", "li", sql="""SELECT sales_id AS InvoiceNo, placed AS OrderDatetime, CAST(store_id AS BIGINT) AS StoreCode,
  'P' || item_id_id AS ProductCode, CAST(quantity AS BIGINT) AS quantity, original_price AS PriceNet FROM li JOIN o ON o.id = sales_id""")
query("scan_dimensions_csv", "cat", "combo", sql="""SELECT 'categories' AS dimension, item_id_id AS a, ProductCode AS b,
  trim(base_label) AS c, dri_label AS d FROM cat
  UNION ALL SELECT 'combos', h, c, 'P' || h, 'P' || c FROM combo""")
query("scan_complaints", "o", sql="SELECT id AS order_id FROM o WHERE has_query")
query("sink_order_features", "o", sql=f"""SELECT id AS order_id, cust AS algonomy_id, placed AS order_placed_datetime, total_price,
  {daypart('placed')} AS order_time_of_day, {weekend('placed')} AS is_weekend, strftime(placed, '%Y-%m') AS order_month
  FROM o WHERE cust IS NOT NULL AND {WINDOW}""")
query("filter_date_window", "o", sql=f"""SELECT id, placed AS order_placed_datetime, delivered AS order_delivery_datetime,
  placed AS schedule_datetime FROM o WHERE {WINDOW}""")
query("filter_exclude_store_window", "o", sql=f"""SELECT id AS InvoiceNo, placed AS BussTime, store_id AS StoreCode
  FROM o WHERE {WINDOW} AND store_id <> 13""")
query("filter_window_missing_store", "o", sql=f"""SELECT id AS InvoiceNo, placed AS BussTime,
  CASE WHEN id % 7 <> 0 THEN store_id END AS StoreCode
  FROM o WHERE {WINDOW} AND (id % 7 = 0 OR store_id <> 13)""")
query("filter_unmapped_excluded", "li", "cat", sql="""SELECT sales_id, item_id_id, quantity, trim(base_label) AS base_label, dri_label
  FROM li JOIN cat USING (item_id_id) WHERE dri_label IS NOT NULL AND coalesce(trim(base_label), '') <> 'Exclude'""")
query("filter_promo_items", "li", sql="SELECT sales_id, item_id_id, quantity, promo_item FROM li WHERE NOT promo_item")
query("filter_cutoff_window", "o", sql=f"SELECT id, placed AS order_placed_datetime FROM o WHERE placed >= TIMESTAMP '{CUTOFF}'")
query("project_base_features", "o", "store", sql=f"""SELECT {delivery_base('has_query')}
  FROM o LEFT JOIN store ON code = store_id WHERE cust IS NOT NULL""")
query("project_instore_base", "o", "store", sql="""SELECT id AS order_id, placed AS order_placed_datetime, placed AS BussTime,
  store_id AS StoreCode, total_price, discounted_price, total_price AS BaseAmount, platform AS TransType, cust AS algonomy_id,
  status_id AS SaleType, store_type, generator AS store_generator_new, city AS store_geographical_city, city AS store_key_city
  FROM o LEFT JOIN store ON code = store_id""")
query("price_without_taxes", "o", sql="""SELECT id, discounted_price,
  CASE WHEN channel = 'instore' THEN total_price + discounted_price ELSE discounted_price + sub_total_price END AS price_without_taxes FROM o""")
query("normalize_keys", sql="""SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS text_id, o_orderkey AS long_id,
  CAST(o_orderdate + INTERVAL 330 MINUTE AS DATE) AS business_date FROM orders""")
query("join_customer_map", "o", sql="SELECT id, user_id, cust AS algonomy_id FROM o WHERE cust IS NOT NULL")
query("join_customer_map_composite", "o", sql="""SELECT id AS InvoiceNo, CAST(placed AS DATE) AS Business_Date, store_id AS StoreCode,
  cust AS algonomy_id FROM o""")
query("semi_ownapp_customers", "o", "users", sql="""SELECT id, channel, cust AS algonomy_id FROM o
  WHERE channel <> 'ownapp' AND cust IN (SELECT cust FROM users)""")
query("join_store_details", "o", "store", sql="""SELECT id, store_id AS store_id_id, CAST(code AS VARCHAR) AS dsr_code, store_name,
  store_type, city AS geographical_city, city AS key_city, generator AS generator_new FROM o LEFT JOIN store ON code = store_id""")
query("flag_orders_with_queries", "o", sql="SELECT id, has_query FROM o")
query("join_item_categories", "li", "cat", sql="""SELECT sales_id, item_id_id, quantity, ProductCode, base_label, dri_label
  FROM li LEFT JOIN cat USING (item_id_id)""")
query("semi_items_in_orders", "o", "li", sql=f"""SELECT sales_id AS InvoiceNo, 'P' || item_id_id AS ProductCode, quantity, original_price AS PriceNet
  FROM li WHERE sales_id IN (SELECT id FROM o WHERE store_id <> 13 AND {WINDOW})""")
query("choice_counts", "dlv_pair", sql="SELECT sales_id, item_id_id, choice_count, order_quantity FROM dlv_pair")
query("remove_choice_items", "dlv_removed", "li", sql="""SELECT sales_id, item_id_id, quantity, original_price
  FROM li ANTI JOIN dlv_removed USING (sales_id, item_id_id) WHERE NOT promo_item""")
query("remove_choice_items_instore", "ins_removed", "o", "li", sql="""SELECT sales_id AS InvoiceNo, 'P' || item_id_id AS ProductCode, quantity,
  original_price AS PriceNet FROM li ANTI JOIN ins_removed USING (sales_id, item_id_id) SEMI JOIN o ON o.id = sales_id""")
query("price_bucket_presence", "clean", sql=f"SELECT sales_id AS order_id, {bucket_presence()} FROM clean GROUP BY sales_id")
query("dri_category_presence", "clean", sql=f"SELECT sales_id AS order_id, {presence(TYPE_COLS, 'dri')} FROM clean GROUP BY sales_id")
query("base_category_presence", "clean", sql=f"SELECT sales_id AS order_id, {presence(BASE_COLS, 'base')} FROM clean GROUP BY sales_id")
query("order_item_stats", "raw_order", sql="SELECT sales_id AS order_id, customization_flag, veg_indicator, item_count, veg_count FROM raw_order")
query("instore_item_count", "raw_order", "o", sql="SELECT sales_id AS order_id, item_count FROM raw_order SEMI JOIN o ON o.id = sales_id")
query("promo_items", "raw_order", sql="SELECT sales_id AS order_id, promo_items FROM raw_order")
query("unique_dri_in_order", "clean", sql=f"""SELECT sales_id AS order_id, {label_list('dri')} AS {N.DRI_LIST}
  FROM clean WHERE dri IS NOT NULL GROUP BY sales_id""")
query("unique_base_in_order", "clean", sql=f"""SELECT sales_id AS order_id, {label_list('base')} AS {N.BASE_LIST}
  FROM clean WHERE base IS NOT NULL GROUP BY sales_id""")
query("order_features", "dlv_feat", sql=f"SELECT {order_feature_columns(False)} FROM dlv_feat")
query("order_features_aggregator", "agg_feat", sql=f"SELECT {order_feature_columns(False, 'false')} FROM agg_feat")
query("order_features_instore", "ins_feat", sql=f"SELECT {order_feature_columns(True)} FROM ins_feat")
query("union_channels", "u", sql=f"""SELECT cust AS algonomy_id, id AS order_id, placed AS order_placed_datetime,
  CASE WHEN channel = 'ownapp' THEN delivered END AS order_delivery_datetime, total_price, discounted_price, price_without_taxes,
  order_time_of_day, is_weekend, coalesce({N.DRI_LIST}, []) AS {N.DRI_LIST}, coalesce({N.BASE_LIST}, []) AS {N.BASE_LIST},
  {', '.join(q(c) for c in FLAG_COLS)}, channel FROM u""")
query("avg_discount_pct", "agg", sql=f"SELECT algonomy_id, {PCT} FROM agg")
query("unique_base_per_customer", "agg", sql=f"SELECT algonomy_id, {N.BASE_LIST}, {BASE_COUNT} FROM agg")
query("unique_dri_per_customer", "agg", sql=f"SELECT algonomy_id, {N.DRI_LIST}, {DRI_COUNT} FROM agg")
query("unique_labels_after_dimension_change", "agg", sql=f"SELECT algonomy_id, {N.DRI_LIST}, {DRI_COUNT} FROM agg")
query("customer_order_metrics", "agg", sql=f"SELECT algonomy_id, {ORDER_COUNTS}, {WEEK}, {MEANS}, {TIMES} FROM agg")
query("channel_label", "agg", sql=f"SELECT algonomy_id, {LABEL} FROM agg")
query("channel_count", "agg", sql=f"SELECT algonomy_id, {WEEK}, {CHANNEL_COUNT} FROM agg")
query("recency_tenure", "agg", sql=f"SELECT algonomy_id, {date_cols('omnichannel')}, {date_cols('ownapp')} FROM agg")
query("daypart_counts", "agg", sql=f"SELECT algonomy_id, {DAYPARTS} FROM agg")
query("daypart_combos", "agg", sql=f"SELECT algonomy_id, {DAYPARTS}, {COMBOS} FROM agg")
query("price_bucket_orders", "agg", sql=f"SELECT algonomy_id, {', '.join(q(n) for n in bucket_order_cols())} FROM agg")
query("category_orders", "agg", sql=f"SELECT algonomy_id, {', '.join(q(n) for n in category_order_cols())} FROM agg")
query("avg_delivery_minutes", "agg", sql=f"SELECT algonomy_id, {MINUTES} FROM agg")
query("customer_features", "cust", sql="SELECT * FROM cust")
query("localize_timestamps", sql="SELECT event_id, ts + INTERVAL 330 MINUTE AS local_ts FROM events")
query("order_time_of_day", sql=f"SELECT event_id, {daypart('(ts + INTERVAL 330 MINUTE)')} AS order_time_of_day FROM events")
query("is_weekend", sql=f"SELECT event_id, {weekend('(ts + INTERVAL 330 MINUTE)')} AS is_weekend FROM events")
query("price_bucket", "li", sql=f"SELECT sales_id, item_id_id, original_price, {bucket('original_price')} AS price_bucket FROM li")
query("normalize_category", sql=r"""SELECT p_partkey, lower(trim(regexp_replace(' Café ' || p_name || ' & (' || p_brand || ') ',
  '[^\p{L}\p{N}_]+', '_', 'g'), '_')) AS label FROM part""")
query("ensure_list", sql="""SELECT p_partkey, CASE WHEN p_partkey % 29 <> 0 THEN [p_brand, p_type] ELSE CAST([] AS VARCHAR[]) END AS labels FROM part""")

LIGHT = ", ".join(q(c) for c in (*spec.WEEK_COUNTS, *spec.DAYPART_COUNTS))
LIGHT_FLAGS = {c: c.replace("_count", "_flag") for c in (*spec.WEEK_COUNTS, *spec.DAYPART_COUNTS)}


def short_flag(name: str) -> str:
    stripped = name.removeprefix("omnichannel_")
    return spec.RENAMES.get(stripped, stripped)


query("create_flags", "cust", sql=f"""SELECT algonomy_id, ownapp_order_count, channel_count,
  {', '.join(f'{flag(c)} AS {q(f)}' for c, f in LIGHT_FLAGS.items())} FROM cust""")
query("rename_features", "cust", sql=f"""SELECT algonomy_id, ownapp_order_count, channel_count,
  {', '.join(f'{flag(c)} AS {q(short_flag(f))}' for c, f in LIGHT_FLAGS.items())} FROM cust""")
query("segment_load_filter", "base", sql=f"SELECT {', '.join(spec.KEEP)} FROM base")
query("segment_band", "cust", sql="""SELECT algonomy_id, ownapp_order_count,
  CASE WHEN ownapp_order_count < 6 THEN '1_5' WHEN ownapp_order_count <= 15 THEN '6_15' ELSE '15_plus' END AS band FROM cust""")
query("segment_rules_grid", "grid_ranked", sql=f"SELECT * EXCLUDE (rnk), {name_of('rnk')} AS Segment FROM grid_ranked")
query("segment_dedupe", "grid_ranked", sql=f"""SELECT algonomy_id, {name_of('rnk')} AS Segment FROM
  (SELECT algonomy_id, min(rnk) AS rnk FROM grid_ranked WHERE rnk IS NOT NULL
   GROUP BY algonomy_id, list_extract({sql_list(RANK_BAND)}, rnk + 1))""")
query("segment_summary", "ranked", sql=f"""SELECT e.Segment, count(r.rnk) AS customer_count,
  CAST(coalesce(sum(r.ownapp_order_count), 0) AS BIGINT) AS total_orders,
  CASE WHEN count(r.rnk) > 0 THEN round_even(sum(r.ownapp_order_count)::DOUBLE / count(r.rnk), 2) END AS avg_orders
  FROM (SELECT unnest({sql_list(SEGMENTS)}) AS Segment) e LEFT JOIN ranked r ON e.Segment = {name_of('r.rnk')} GROUP BY e.Segment""")
query("rule_segments", "seg", sql="SELECT algonomy_id, Segment FROM seg WHERE Segment IS NOT NULL")
query("segments_with_features", "seg", sql="SELECT * FROM seg")

CAP_LIGHT = ["channel_count", *spec.WEEK_COUNTS, *spec.DAYPART_COUNTS]
query("cap_outliers", "cust", sql=f"""SELECT algonomy_id, ownapp_order_count, {', '.join(
    r6(f'least(greatest(cust.{q(c)}::DOUBLE, b.{q("lo_" + c)}), b.{q("hi_" + c)})') + f' AS {q(c)}' for c in CAP_LIGHT)}
  FROM cust CROSS JOIN (SELECT {', '.join(
    f'quantile_cont({q(c)}::DOUBLE, 0.01) AS {q("lo_" + c)}, quantile_cont({q(c)}::DOUBLE, 0.99) AS {q("hi_" + c)}' for c in CAP_LIGHT)} FROM cust) b""")
query("kmeans_assign", sql=f"""SELECT vec_id, {label('d')} AS microcluster FROM
  (SELECT vec_id, {distances('v', spec.EMBEDDING_MODEL)} AS d FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings))""")
query("microsegments", "micro", sql="SELECT * FROM micro")
# every order line as a customer: all plans are scored and capped
cte("grid_base", sql=f"""
SELECT {', '.join(spec.grid_sql())} FROM lineitem""")
cte("grid_flagged", "grid_base", sql=f"""
SELECT *, unique_category_base_products_count AS unique_cat_base_count,
  {', '.join(f'{flag(src)} AS {q(name)}' for name, src in RULE_FLAGS.items())} FROM grid_base""")
cte("grid_seg", "grid_flagged", sql=f"SELECT *, {name_of(rank_case())} AS Segment FROM grid_flagged")
cte("grid_planned", "grid_seg", sql=f"SELECT grid_seg.*, plan FROM grid_seg JOIN {plan_rows()} ON grid_seg.Segment = plan.seg")
cte("grid_bounds", "grid_planned", sql=CTE["bounds"][1].replace("FROM planned", "FROM grid_planned"))
cte("grid_vec", "grid_planned", "grid_bounds", sql=f"""
SELECT p.algonomy_id, p.plan, {vector()} AS v FROM grid_planned p LEFT JOIN grid_bounds b ON p.plan = b.plan""")
query("microsegments_grid", "grid_vec", sql=f"""SELECT algonomy_id, plan AS Segment, {label('d')} AS microcluster
  FROM (SELECT algonomy_id, plan, {DIST} AS d FROM grid_vec)""")
query("fit_models", "grid_vec", sql=f"""SELECT k.model_key, 4 AS centers, list_extract({sql_list(spec.MODEL_FEATURES)}, i) AS feature,
  {r6('avg(coalesce(v[i], 0))')} AS mean, {r6('stddev_samp(coalesce(v[i], 0))')} AS scale
  FROM grid_vec JOIN (VALUES {', '.join(f"('{name}', '{key}')" for name, _, key in spec.PLAN_SOURCES)}) AS k(plan, model_key) USING (plan)
  CROSS JOIN (SELECT CAST(unnest(range(1, {len(spec.MODEL_FEATURES) + 1})) AS INTEGER) AS i) GROUP BY k.model_key, i""")
query("microcluster_sizes", "micro", sql="SELECT Segment, microcluster, count(*) AS customers FROM micro GROUP BY ALL")
query("quality_counters", "o", "li", "cat", "clean", "store", sql=f"""
SELECT 'orders' AS step, 'rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM o
UNION ALL SELECT 'window', 'rows', CAST(count(*) AS VARCHAR) FROM o WHERE {WINDOW}
UNION ALL SELECT 'window', 'first', strftime(min(placed), '%Y-%m-%d %H:%M:%S') FROM o WHERE {WINDOW}
UNION ALL SELECT 'window', 'last', strftime(max(placed), '%Y-%m-%d %H:%M:%S') FROM o WHERE {WINDOW}
UNION ALL SELECT 'customers', 'rows', CAST(count(*) AS VARCHAR) FROM o WHERE cust IS NOT NULL
UNION ALL SELECT 'customers', 'missing', CAST(count(*) AS VARCHAR) FROM o WHERE cust IS NULL
UNION ALL SELECT channel, 'first', strftime(min(placed), '%Y-%m-%d %H:%M:%S') FROM o WHERE {WINDOW} GROUP BY channel
UNION ALL SELECT channel, 'last', strftime(max(placed), '%Y-%m-%d %H:%M:%S') FROM o WHERE {WINDOW} GROUP BY channel
UNION ALL SELECT 'kept_items', 'removed', CAST((SELECT count(*) FROM li) - (SELECT count(*) FROM clean) AS VARCHAR)
UNION ALL SELECT 'stores', 'missing_store', CAST(count(*) AS VARCHAR) FROM o WHERE store_id NOT IN (SELECT code FROM store)
UNION ALL SELECT 'complaints', 'flagged', CAST(count(*) AS VARCHAR) FROM o WHERE has_query
UNION ALL SELECT 'items', 'rows', CAST(count(*) AS VARCHAR) FROM li LEFT JOIN cat USING (item_id_id)
UNION ALL SELECT 'items', 'missing_category', CAST(count(*) AS VARCHAR) FROM li LEFT JOIN cat USING (item_id_id) WHERE dri_label IS NULL
UNION ALL SELECT 'kept_items', 'rows', CAST(count(*) AS VARCHAR) FROM clean
UNION ALL SELECT 'categories', 'duplicate_keys', CAST(count(*) AS VARCHAR) FROM (SELECT item_id_id FROM cat GROUP BY 1 HAVING count(*) > 1)""")
# written and read again, the rows are the same
for written, same in (("scan_csv_columns", "scan_instore_csv"), ("sink_customer_features", "customer_features"), ("sink_segments", "rule_segments"),
                      ("sink_microsegments", "microsegments"), ("model_table", "microsegments_grid")):
    QUERIES[written] = QUERIES[same]
query("reread_ownapp_customers", "o", sql=f"SELECT DISTINCT cust AS algonomy_id FROM o WHERE cust IS NOT NULL AND channel = 'ownapp' AND {WINDOW}")
query("reread_recent_orders", "o", sql=f"""SELECT id AS order_id, cust AS algonomy_id, placed AS order_placed_datetime, total_price,
  {daypart('placed')} AS order_time_of_day FROM o WHERE cust IS NOT NULL AND {WINDOW} AND placed >= TIMESTAMP '{CUTOFF}'""")


def statement(name: str) -> str:
    needs, sql = QUERIES[name]
    ordered: list[str] = []

    def visit(n: str) -> None:
        for dep in CTE[n][0]:
            visit(dep)
        if n not in ordered:
            ordered.append(n)

    for n in needs:
        visit(n)
    if not ordered:
        return sql
    body = ",\n".join(f"{n} AS MATERIALIZED ({CTE[n][1]})" for n in ordered)
    return f"WITH {body}\n{sql}"


def statements() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
