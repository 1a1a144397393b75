"""DuckDB SQL of the registered queries, put together from common table expressions."""

from __future__ import annotations

import re

from tidewell.operators import candidates, drift, features, offers
from tidewell.plans.queries import BACK, CATEGORIES, NUDGE, NUMERIC, SQL_STRATEGIES, TRAIN, WS

W = f"DATE '{WS}'"
RECENCY = "CASE WHEN {d} IS NULL THEN 'never' WHEN {d} <= 7 THEN '<=1 week' WHEN {d} <= 28 THEN '<=4 weeks' WHEN {d} <= 84 THEN '<=12 weeks' WHEN {d} <= 364 THEN '<=52 weeks' ELSE '>52 weeks' END"
RANKS = ", ".join(f"rank_{s}" for s in candidates.STRATEGIES)
PRICE_KEYS = "window_start, customer_id, article_id"


def _starts(*days: object) -> str:
    return "SELECT unnest([" + ", ".join(f"DATE '{d}'" for d in days) + "]) AS window_start"


def _pool(cap: str = "100", source: str = "every") -> str:
    ranks = ", ".join(f"min(rank) FILTER (strategy = '{s}') AS rank_{s}" for s in candidates.STRATEGIES)
    return f"""SELECT * EXCLUDE pool_rank FROM (
      SELECT *, row_number() OVER (PARTITION BY window_start, customer_id ORDER BY n_strategies DESC, best_rank, article_id) AS pool_rank FROM (
        SELECT window_start, customer_id, article_id, list_sort(list(DISTINCT strategy)) AS strategies, count(DISTINCT strategy) AS n_strategies, min(rank) AS best_rank, {ranks}
        FROM {source} GROUP BY ALL)) WHERE pool_rank <= {cap}"""


def _count_since(days: int, what: str = "*") -> str:
    return f"count({what}) FILTER (t_dat >= window_start - {days})"


#: Name to query; names after FROM and JOIN say what each needs.
CTES: dict[str, str] = {
    "tx": """SELECT CAST(o_orderdate AS DATE) AS t_dat, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS customer_id, lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS article_id,
      l_extendedprice AS price, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS sales_channel_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "articles": """SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS article_id, lpad(CAST(p_partkey // 5 AS VARCHAR), 7, '0') AS product_code, split_part(p_name, ' ', 1) AS colour_group_name, split_part(p_name, ' ', 2) AS garment_group_name,
      p_brand AS department_name, p_type AS product_type_name, 'group ' || CAST(p_size // 10 AS VARCHAR) AS index_group_name, CASE WHEN p_partkey % 7 <> 0 THEN text END AS detail_desc FROM part LEFT JOIN documents ON doc_id = p_partkey""",
    "customers": """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id, CASE WHEN c_nationkey % 2 = 0 THEN 1.0 END AS FN, CASE WHEN c_nationkey % 4 = 0 THEN 1.0 END AS Active, c_mktsegment AS club_member_status,
      CASE c_nationkey % 3 WHEN 0 THEN 'NONE' WHEN 1 THEN 'Regularly' END AS fashion_news_frequency, CAST(CASE WHEN c_custkey % 17 <> 0 THEN 18 + c_custkey % 60 END AS INTEGER) AS age, lpad(CAST(c_nationkey AS VARCHAR), 64, '0') AS postal_code FROM customer""",
    "vectors": "SELECT lpad(CAST(vec_id AS VARCHAR), 10, '0') AS article_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vector FROM embeddings",
    "aged": "SELECT *, CASE WHEN age IS NULL THEN 'unknown' WHEN age <= 25 THEN '<25' WHEN age <= 35 THEN '25-34' WHEN age <= 45 THEN '35-44' WHEN age <= 55 THEN '45-54' WHEN age <= 65 THEN '55-64' ELSE '65+' END AS age_bucket FROM customers",
    "history": "SELECT tx.*, window_start FROM starts JOIN tx ON t_dat < window_start",
    "truth": "SELECT DISTINCT window_start, customer_id, article_id FROM starts JOIN tx ON t_dat >= window_start AND t_dat <= window_start + 6",
    "repurchase_all": """SELECT window_start, customer_id, article_id, row_number() OVER (PARTITION BY window_start, customer_id ORDER BY max(t_dat) DESC, article_id) AS rank
      FROM history WHERE t_dat >= window_start - 364 GROUP BY window_start, customer_id, article_id""",
    "colour_variant_all": """SELECT window_start, customer_id, v.article_id, row_number() OVER (PARTITION BY window_start, customer_id ORDER BY max(t_dat) DESC, v.article_id) AS rank
      FROM history h JOIN articles a ON a.article_id = h.article_id JOIN articles v ON v.product_code = a.product_code AND v.article_id <> a.article_id WHERE t_dat >= window_start - 364 GROUP BY window_start, customer_id, v.article_id""",
    "recent_top_all": "SELECT window_start, article_id, count(*) AS n, row_number() OVER (PARTITION BY window_start ORDER BY count(*) DESC, article_id) AS rank FROM history WHERE t_dat >= window_start - 7 GROUP BY window_start, article_id",
    "recent_top": "SELECT * FROM recent_top_all WHERE rank <= 20",
    "recent_popularity": "SELECT window_start, customer_id, article_id, rank FROM (SELECT DISTINCT customer_id FROM customers), recent_top",
    "segment_top_all": """SELECT window_start, age_bucket, article_id, count(*) AS n, row_number() OVER (PARTITION BY window_start, age_bucket ORDER BY count(*) DESC, article_id) AS rank
      FROM history JOIN aged USING (customer_id) WHERE t_dat >= window_start - 7 GROUP BY window_start, age_bucket, article_id""",
    "segment_top": "SELECT * FROM segment_top_all WHERE rank <= 20",
    "segment_popularity": "SELECT window_start, customer_id, article_id, rank FROM aged JOIN segment_top USING (age_bucket)",
    "every": """SELECT *, 'repurchase' AS strategy FROM repurchase_all WHERE rank <= 30 UNION ALL SELECT *, 'colour_variant' FROM colour_variant_all WHERE rank <= 30
      UNION ALL SELECT *, 'recent_popularity' FROM recent_popularity UNION ALL SELECT *, 'segment_popularity' FROM segment_popularity""",
    "pool": _pool(),
    "hits": "SELECT pool.*, truth.article_id IS NOT NULL AS hit FROM pool LEFT JOIN truth USING (window_start, customer_id, article_id)",
    "labelled": """SELECT * EXCLUDE (draw, positives) FROM (
      SELECT *, CAST(hit AS INTEGER) AS label, sum(CAST(hit AS INTEGER)) OVER (PARTITION BY window_start, customer_id) AS positives,
        row_number() OVER (PARTITION BY window_start, customer_id, hit ORDER BY md5('42:' || customer_id || ':' || article_id), article_id) AS draw FROM hits)
      WHERE positives > 0 AND (hit OR draw <= 10 * positives)""",
    "recency": f"""SELECT window_start, customer_id, {RECENCY.format(d="date_diff('day', last, window_start)")} AS recency_bucket
      FROM (SELECT DISTINCT customer_id FROM customers) CROSS JOIN starts LEFT JOIN (SELECT window_start, customer_id, max(t_dat) AS last FROM history GROUP BY ALL) USING (window_start, customer_id)""",
    "prices": f"SELECT article_id, avg(price) AS price FROM tx WHERE t_dat >= {W} - 28 AND t_dat < {W} GROUP BY article_id",
    "cost": "SELECT quantile_cont(price, 0.5) AS median_price, quantile_cont(price, 0.5) * 0.001 AS contact_cost FROM prices",
    "sold": f"SELECT DISTINCT article_id FROM tx WHERE t_dat >= {W} - 7 AND t_dat < {W}",
    "bought": f"SELECT DISTINCT customer_id, article_id FROM tx WHERE t_dat >= {W} - 14 AND t_dat < {W}",
    "surrogate": """SELECT hits.* EXCLUDE hit, CAST(hit AS BIGINT) AS label, CAST(n_strategies * 100 - best_rank AS DOUBLE) AS ranker_score, round(1.0 / (20 + best_rank), 6) AS p_purchase, price,
      CAST(('0x' || substr(md5('42:' || customer_id), 1, 8)) AS BIGINT) % 100 AS bucket FROM hits LEFT JOIN prices USING (article_id)""",
    "ranked": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start, customer_id ORDER BY ranker_score DESC, article_id) AS rank_position FROM surrogate) WHERE rank_position <= 12",
    "scored12": """SELECT r.*, s.article_id IS NOT NULL AND b.article_id IS NULL AS eligible, median_price, contact_cost, 0.5 * price * p_purchase - contact_cost AS expected_value
      FROM ranked r LEFT JOIN sold s ON s.article_id = r.article_id LEFT JOIN bought b ON b.article_id = r.article_id AND b.customer_id = r.customer_id, cost""",
    "selected": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY expected_value DESC, ranker_score DESC, article_id) AS k FROM scored12 WHERE eligible AND expected_value > 0) WHERE k = 1",
    "top1": "SELECT * FROM scored12 WHERE rank_position = 1",
    "who": f"""SELECT window_start, customer_id, club_member_status, fashion_news_frequency, age_bucket, coalesce(txn_count_total, 0) AS txn_count_total, coalesce(distinct_article_count_total, 0) AS distinct_article_count_total, mean_purchase_price, std_purchase_price,
      share_sales_channel_1, share_sales_channel_2, {", ".join(f"coalesce({c}_{w}, 0) AS {c}_{w}" for w, _ in features.TRAILING for c in ("txn_count", "distinct_article_count"))}, date_diff('day', last, window_start) AS days_since_last_purchase
      FROM aged CROSS JOIN starts LEFT JOIN (SELECT window_start, customer_id, count(*) AS txn_count_total, count(DISTINCT article_id) AS distinct_article_count_total, avg(price) AS mean_purchase_price, stddev_samp(price) AS std_purchase_price, max(t_dat) AS last,
        avg(CAST(sales_channel_id = 1 AS INTEGER)) AS share_sales_channel_1, avg(CAST(sales_channel_id = 2 AS INTEGER)) AS share_sales_channel_2,
        {", ".join(f"{_count_since(d)} AS txn_count_{w}, {_count_since(d, 'DISTINCT article_id')} AS distinct_article_count_{w}" for w, d in features.TRAILING)} FROM history GROUP BY ALL) USING (window_start, customer_id)""",
    "what": f"""SELECT window_start, article_id, product_type_name, department_name, index_group_name, garment_group_name, article_mean_price, coalesce(buyers, 0) AS distinct_buyers_total,
      {", ".join(f"coalesce(n_{w}, 0) AS purchase_count_{w}" for w, _ in features.TRAILING)}, coalesce(n_1w - before, 0) AS purchase_count_wow_trend, date_diff('day', first, window_start) AS days_since_first_sale, date_diff('day', last, window_start) AS days_since_last_sale
      FROM articles CROSS JOIN starts LEFT JOIN (SELECT window_start, article_id, avg(price) AS article_mean_price, count(DISTINCT customer_id) AS buyers, min(t_dat) AS first, max(t_dat) AS last,
        {", ".join(f"{_count_since(d)} AS n_{w}" for w, d in features.TRAILING)}, count(*) FILTER (t_dat >= window_start - 14 AND t_dat < window_start - 7) AS before FROM history GROUP BY ALL) USING (window_start, article_id)""",
    "recent_text": """SELECT window_start, customer_id, place, avg(value) AS value FROM (
      SELECT window_start, customer_id, unnest(range(len(vector))) AS place, unnest(vector) AS value FROM (
        SELECT window_start, customer_id, article_id, row_number() OVER (PARTITION BY window_start, customer_id ORDER BY t_dat DESC, article_id) AS k FROM history) JOIN vectors USING (article_id) WHERE k <= 10) GROUP BY ALL""",
    "recent_list": "SELECT window_start, customer_id, list(value ORDER BY place) AS recent FROM recent_text GROUP BY ALL",
    "counted": "SELECT window_start, customer_id, article_id, count(*) AS n, max(t_dat) AS last FROM history GROUP BY ALL",
    "pairs": f"""SELECT p.window_start, p.customer_id, p.article_id, coalesce(own.n, 0) AS prior_purchase_count_this_article, date_diff('day', own.last, p.window_start) AS days_since_last_purchase_this_article,
      {", ".join(f"CAST(coalesce(by_{t}.n, 0) AS BIGINT) AS {name}" for t, name in (("product", features.PAIR[2]), ("colour", features.PAIR[3]), ("department", features.PAIR[4])))},
      CASE WHEN mean_purchase_price <> 0 THEN article_mean_price / mean_purchase_price END AS price_ratio_to_customer_mean,
      coalesce(CASE WHEN list_inner_product(vector, vector) * list_inner_product(recent, recent) <> 0 THEN list_inner_product(vector, recent) / (sqrt(list_inner_product(vector, vector)) * sqrt(list_inner_product(recent, recent))) END, 0.0) AS text_cosine_similarity
      FROM @pool p LEFT JOIN articles a USING (article_id) LEFT JOIN counted own ON own.window_start = p.window_start AND own.customer_id = p.customer_id AND own.article_id = p.article_id
      {" ".join(f"LEFT JOIN (SELECT window_start, customer_id, {c}, sum(n) AS n FROM counted JOIN articles USING (article_id) WHERE {c} IS NOT NULL GROUP BY ALL) by_{t} ON by_{t}.window_start = p.window_start AND by_{t}.customer_id = p.customer_id AND by_{t}.{c} = a.{c}" for t, c in (("product", "product_code"), ("colour", "colour_group_name"), ("department", "department_name")))}
      LEFT JOIN who ON who.window_start = p.window_start AND who.customer_id = p.customer_id LEFT JOIN what ON what.window_start = p.window_start AND what.article_id = p.article_id
      LEFT JOIN recent_list t ON t.window_start = p.window_start AND t.customer_id = p.customer_id LEFT JOIN vectors v ON v.article_id = p.article_id""",
    "provenance": f"SELECT {PRICE_KEYS}, n_strategies, best_rank, {RANKS}, {', '.join(f"list_contains(strategies, '{s}') AS from_{s}" for s in candidates.STRATEGIES)} FROM @pool",
    "assembled": f"""SELECT {PRICE_KEYS}, {", ".join(features.FEATURES)} FROM pairs JOIN provenance USING ({PRICE_KEYS}) LEFT JOIN who USING (window_start, customer_id) LEFT JOIN what USING (window_start, article_id)""",
    "matrix": f"SELECT assembled.*, CAST(label AS BIGINT) AS label FROM assembled JOIN labelled USING ({PRICE_KEYS})",
    "purchasers": "SELECT window_start, customer_id, count(*) AS m FROM truth GROUP BY ALL",
}


def _ap(source: str) -> str:
    return f"""SELECT window_start, customer_id, coalesce(gain, 0.0) / least(m, 12) AS ap FROM purchasers LEFT JOIN (
      SELECT window_start, customer_id, sum(so_far / rank_position) AS gain FROM (
        SELECT s.*, t.article_id IS NOT NULL AS hit, sum(CAST(t.article_id IS NOT NULL AS INTEGER)) OVER (PARTITION BY s.window_start, s.customer_id ORDER BY rank_position, s.article_id) AS so_far
        FROM {source} s LEFT JOIN truth t ON t.window_start = s.window_start AND t.customer_id = s.customer_id AND t.article_id = s.article_id) WHERE hit GROUP BY ALL) USING (window_start, customer_id)"""


CTES |= {
    "ap_ranker": _ap("ranked"),
    "pool_order": "SELECT window_start, customer_id, article_id, rank_position FROM (SELECT *, row_number() OVER (PARTITION BY window_start, customer_id ORDER BY best_rank, article_id) AS rank_position FROM pool) WHERE rank_position <= 12",
    "ap_pool": _ap("pool_order"),
    "popularity_order": "SELECT window_start, customer_id, article_id, rank AS rank_position FROM purchasers JOIN recent_top USING (window_start) WHERE rank <= 12",
    "ap_popularity": _ap("popularity_order"),
    "ap_oracle": "SELECT window_start, customer_id, least(coalesce(found, 0), 12) / least(m, 12) AS ap FROM purchasers LEFT JOIN (SELECT window_start, customer_id, count(*) AS found FROM truth JOIN pool USING (window_start, customer_id, article_id) GROUP BY ALL) USING (window_start, customer_id)",
    "true_met": "SELECT truth.*, strategies, coalesce(n_strategies, 0) AS n_strategies, recency_bucket FROM truth LEFT JOIN pool USING (window_start, customer_id, article_id) LEFT JOIN recency USING (window_start, customer_id)",
    "store": """SELECT s.customer_id, s.rank_position AS rank, s.article_id, s.ranker_score, s.p_purchase, s.eligible, '["' || array_to_string(s.strategies, '","') || '"]' AS strategies, s.price, o.customer_id IS NOT NULL AS selected, o.expected_value
      FROM scored12 s LEFT JOIN selected o ON o.customer_id = s.customer_id AND o.article_id = s.article_id""",
}


def sql(body: str, *starts: object, pool: str = "pool") -> str:
    """``body`` behind the expressions it needs, for the given window starts."""
    body = body.replace("@pool", pool)
    known = {**{k: v.replace("@pool", pool) for k, v in CTES.items()}, "starts": _starts(*(starts or (WS,)))}
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\b[a-z_0-9]+\b", text):
            if name in known and name not in order and re.search(rf"(?:FROM|JOIN|,)\s+\(?{name}\b", text):
                need(known[name])
                if name not in order:
                    order.append(name)

    need(body)
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order) + f"\n{body}" if order else body


def _r(names: str | list[str], digits: int = 6) -> str:
    return ", ".join(f"round({n.strip()}, {digits}) AS {n.strip()}" for n in (names.split(",") if isinstance(names, str) else names))


def _rounded(source: str, doubles: list[str], digits: int = 6) -> str:
    return f"SELECT * REPLACE ({_r(doubles, digits)}) FROM {source}"


CUSTOMER_DOUBLES = ["mean_purchase_price", "std_purchase_price", "share_sales_channel_1", "share_sales_channel_2"]
FEATURE_DOUBLES = [*CUSTOMER_DOUBLES, "article_mean_price", "price_ratio_to_customer_mean", "text_cosine_similarity"]
REPORT = "SELECT window_start, '{scope}' AS scope, '{name}' AS name, count(*) FILTER ({hit}) AS hits, count(*) FILTER ({of}) AS total, round(CASE WHEN count(*) FILTER ({of}) > 0 THEN count(*) FILTER ({hit}) / count(*) FILTER ({of}) END, 6) AS recall FROM true_met GROUP BY window_start"


def _report() -> str:
    hit = "strategies IS NOT NULL"
    parts = [REPORT.format(scope="pool", name="all", hit=hit, of="true")]
    for s in candidates.STRATEGIES:
        has = f"{hit} AND list_contains(strategies, '{s}')"
        parts += [REPORT.format(scope="strategy", name=s, hit=has, of="true"), REPORT.format(scope="marginal", name=s, hit=f"{has} AND n_strategies = 1", of="true")]
    for b in ("<=1 week", "<=4 weeks", "<=12 weeks", "<=52 weeks", ">52 weeks", "never"):
        parts.append(REPORT.format(scope="recency", name=b, hit=f"{hit} AND recency_bucket = '{b}'", of=f"recency_bucket = '{b}'"))
    return "\nUNION ALL ".join(parts)


def _sweep() -> str:
    recall = "SELECT window_start, count(p.article_id) AS hits, count(*) AS total, round(count(p.article_id) / count(*), 6) AS recall, '{n}' AS allocation FROM truth LEFT JOIN ({pool}) p USING (window_start, customer_id, article_id) GROUP BY window_start"
    parts = []
    for n, caps in candidates.SWEEP.items():
        cut = " UNION ALL ".join([
            f"SELECT window_start, customer_id, article_id, rank, 'repurchase' AS strategy FROM repurchase_all WHERE rank <= {caps[0]}",
            f"SELECT window_start, customer_id, article_id, rank, 'colour_variant' FROM colour_variant_all WHERE rank <= {caps[1]}",
            f"SELECT window_start, customer_id, article_id, rank, 'recent_popularity' FROM recent_popularity WHERE rank <= {caps[2]}",
            f"SELECT window_start, customer_id, article_id, rank, 'segment_popularity' FROM segment_popularity WHERE rank <= {caps[3]}",
        ])
        parts.append(recall.format(n=n, pool=_pool(source=f"({cut})")))
    return "\nUNION ALL ".join(parts)


def _bins(source: str, where: str = "true") -> str:
    return f"SELECT *, CAST(floor((row_number() OVER (ORDER BY p_purchase, customer_id, article_id) - 1) * 10 / count(*) OVER ()) AS BIGINT) AS bin FROM {source} WHERE {where}"


def _rule(table: str, column: str, rule: str, bad: str) -> str:
    return f"SELECT '{table if table != 'tx' else 'transactions'}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, count(*) FILTER ({bad}) AS n_bad FROM {table}"


def _contract() -> str:
    parts = []
    for table, columns in {
        "tx": {"t_dat": [], "customer_id": [("width", "length(customer_id) <> 10")], "article_id": [("width", "length(article_id) <> 10")], "price": [("range", "price < 2000")], "sales_channel_id": [("values", "sales_channel_id NOT IN (1, 2)")]},
        "customers": {"customer_id": [("width", "length(customer_id) <> 10")], "FN": None, "Active": None, "club_member_status": None, "fashion_news_frequency": None, "age": [], "postal_code": [("width", "length(postal_code) <> 64")]},
        "articles": {"article_id": [("width", "length(article_id) <> 10")], "product_code": [("width", "length(product_code) <> 7")], "colour_group_name": [], "garment_group_name": [], "department_name": [("width", "length(department_name) <> 8")], "product_type_name": [("values", "product_type_name NOT IN ('ECONOMY', 'SMALL')")], "index_group_name": [], "detail_desc": []},
    }.items():
        for c, rules in columns.items():
            parts.append(_rule(table, c, "type", "false"))
            if rules is not None:
                parts += [_rule(table, c, "not null", f"{c} IS NULL"), *(_rule(table, c, n, bad) for n, bad in rules)]
    for table, c in (("customers", "customer_id"), ("articles", "article_id")):
        parts.append(f"SELECT '{table}', '{c}', 'unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {table} GROUP BY {c})")
    return "\nUNION ALL ".join(parts)


def _thresholds() -> str:
    parts = []
    for what, source, column in (("row", "scored12", "p_purchase"), ("customer", "(SELECT customer_id, max(p_purchase) AS p FROM scored12 GROUP BY customer_id)", "p")):
        parts += [f"SELECT '{what} q{q}' AS name, round(quantile_cont({column}, {q}), 6) AS value FROM {source}" for q in offers.QUANTILES]
        parts.append(f"SELECT '{what} max', round(max({column}), 6) FROM {source}")
    parts += [f"SELECT 'share over {c!r}', round(avg(CAST(o AS INTEGER)), 6) FROM (SELECT customer_id, bool_or(coalesce(0.5 * price * p_purchase > {c!r} * median_price, false)) AS o FROM scored12 GROUP BY customer_id)" for c in offers.THRESHOLDS]
    return "\nUNION ALL ".join(parts)


GRID = f"""SELECT margin, multiplier, count(*) FILTER (margin * best - median_price * multiplier > 0) AS covered, round(count(*) FILTER (margin * best - median_price * multiplier > 0) / (SELECT count(DISTINCT customer_id) FROM customers), 6) AS coverage
  FROM (SELECT customer_id, max(price * p_purchase) AS best, max(median_price) AS median_price FROM scored12 WHERE eligible GROUP BY customer_id), (SELECT unnest([{", ".join(f"CAST({m / 10!r} AS DOUBLE)" for m in offers.MARGINS)}]) AS margin), (SELECT unnest([{", ".join(f"CAST({m / 10000!r} AS DOUBLE)" for m in offers.MULTIPLIERS)}]) AS multiplier) GROUP BY margin, multiplier"""


def _psi() -> str:
    sides = f"sides AS (SELECT *, array_to_string(strategies, ',') AS strategy_list, round(1.0 / (20 + best_rank), 6) AS {drift.PROBABILITY}, CAST(window_start = {W} AS INTEGER) AS cur FROM pool LEFT JOIN prices USING (article_id))"
    parts = []
    for c in [*NUMERIC, drift.PROBABILITY]:
        edges = f"(SELECT list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e FROM sides WHERE cur = 0)"
        parts.append(f"SELECT '{c}' AS column_name, CASE WHEN {c} IS NULL THEN 'null' ELSE CAST(len(list_filter(e, lambda x: x < CAST({c} AS DOUBLE))) AS VARCHAR) END AS bin, cur FROM sides, {edges}")
    for c in CATEGORIES:
        parts.append(f"SELECT '{c}', coalesce(strategy_list, 'null'), cur FROM sides")
    return f"""{sides}, binned AS ({" UNION ALL ".join(parts)}),
      shares AS (SELECT column_name, greatest(sum(1 - cur) / sum(sum(1 - cur)) OVER (PARTITION BY column_name), {drift.FLOOR!r}) AS p, greatest(sum(cur) / sum(sum(cur)) OVER (PARTITION BY column_name), {drift.FLOOR!r}) AS q FROM binned GROUP BY column_name, bin),
      psi AS (SELECT column_name, sum((q - p) * ln(q / p)) AS psi FROM shares GROUP BY column_name)"""


def _with_psi(body: str) -> str:
    head = sql("SELECT 1 FROM pool, prices", BACK, WS)
    return head[: head.rindex("\nSELECT 1")] + ",\n" + _psi() + "\n" + body


def _mapping(source: str) -> str:
    values = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS column_name, coalesce({c}, '__NULL__') AS category FROM {source}" for c in features.CATEGORICAL)
    return f"SELECT column_name, category, row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS code FROM ({values})"


def _encoded() -> str:
    last = TRAIN[3]
    mapping = _mapping(f"(SELECT * FROM matrix WHERE window_start < DATE '{last}')")
    columns = ", ".join(f"coalesce((SELECT code FROM mapping g WHERE g.column_name = '{c}' AND g.category = coalesce(m.{c}, '__NULL__')), -1) AS {c}" for c in features.CATEGORICAL)
    whole = sql(f"SELECT {PRICE_KEYS}, {columns} FROM matrix m WHERE window_start = DATE '{last}'", *TRAIN, pool="labelled")
    at = whole.rindex(f"\nSELECT {PRICE_KEYS}")
    return whole[:at] + f",\nmapping AS ({mapping})" + whole[at:]


def _points(names: str, column: str = "n") -> str:
    table = {"min": "0.0", "p25": "0.25", "median": "0.5", "p75": "0.75", "p90": "0.9", "p99": "0.99", "max": "1.0"}
    return ", ".join(f"round(quantile_cont({column}, {table[n]}), 6) AS {n}" for n in names.split())


LAST = f"SELECT {RECENCY.format(d="date_diff('day', last, (SELECT max(t_dat) FROM tx))")} AS recency_bucket FROM (SELECT DISTINCT customer_id FROM customers) LEFT JOIN (SELECT customer_id, max(t_dat) AS last FROM tx GROUP BY customer_id) USING (customer_id)"

ORACLES: dict[str, str] = {
    "d_label_windows": " UNION ALL ".join([f"SELECT 'train' AS split, DATE '{s}' AS window_start, DATE '{s}' + 6 AS window_end" for s in TRAIN] + [f"SELECT 'validation', {W}, {W} + 6"]),
    "d_history": sql(f"SELECT * REPLACE (round(price, 6) AS price) FROM tx WHERE t_dat < {W}"),
    "d_actual_purchases": sql("SELECT * FROM truth", *TRAIN, WS),
    "d_training_labels": sql(f"SELECT {PRICE_KEYS}, CAST(label AS BIGINT) AS label FROM labelled", *TRAIN),
    "v_contract": sql(_contract()),
    "c_age_buckets": sql("SELECT customer_id, age, age_bucket FROM aged"),
    "c_repurchase": sql("SELECT * FROM repurchase_all WHERE rank <= 30"),
    "c_colour_variant": sql("SELECT * FROM colour_variant_all WHERE rank <= 30"),
    "c_recent_top": sql("SELECT * FROM recent_top"),
    "c_recent_popularity": sql("SELECT * FROM recent_popularity"),
    "c_segment_top": sql("SELECT * FROM segment_top"),
    "c_segment_popularity": sql("SELECT * FROM segment_popularity"),
    "c_pool": sql("SELECT * REPLACE (array_to_string(strategies, ',') AS strategies) FROM pool"),
    "c_report": sql("SELECT strategy, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers FROM every GROUP BY strategy UNION ALL SELECT 'pool', count(*), count(DISTINCT customer_id) FROM pool"),
    "c_without_candidates": sql("SELECT customer_id, window_start FROM customers CROSS JOIN starts WHERE customer_id NOT IN (SELECT customer_id FROM repurchase_all)"),
    "c_cap_sweep": sql(_sweep()),
    "c_cap_reach": sql(" UNION ALL ".join(f"SELECT count(*) AS customers, count(*) FILTER (n >= 30) AS at_cap, CAST(coalesce(sum(n), 0) AS BIGINT) AS raw_rows, round(avg(CAST(n >= 30 AS INTEGER)), 6) AS share_at_cap, round(avg(n), 6) AS mean_rows, '{s}' AS strategy FROM (SELECT window_start, customer_id, count(*) AS n FROM {s}_all GROUP BY ALL)" for s in ("repurchase", "colour_variant"))),
    "f_customer": sql(_rounded("who", CUSTOMER_DOUBLES, 4)),
    "f_article": sql(_rounded("what", ["article_mean_price"], 4)),
    "f_recent_text": sql(_rounded("recent_text", ["value"])),
    "f_pair": sql(_rounded("pairs", ["price_ratio_to_customer_mean", "text_cosine_similarity"])),
    "f_provenance": sql("SELECT * FROM provenance"),
    "f_assembled": sql(_rounded("assembled", FEATURE_DOUBLES, 4)),
    "f_backtest": sql(_rounded("assembled", FEATURE_DOUBLES, 4), BACK),
    "f_training_matrix": sql(_rounded("matrix", FEATURE_DOUBLES, 4), *TRAIN, pool="labelled"),
    "e_recall": sql("SELECT window_start, count(p.article_id) AS hits, count(*) AS total, round(count(p.article_id) / count(*), 6) AS recall FROM truth LEFT JOIN pool p USING (window_start, customer_id, article_id) GROUP BY window_start"),
    "e_over_limit": sql("SELECT window_start, customer_id, count(*) AS n FROM pool GROUP BY ALL HAVING count(*) > 60"),
    "e_recall_report": sql(_report()),
    "e_training_recall": sql(_report(), *TRAIN),
    "e_recency_buckets": sql("SELECT * FROM recency"),
    "e_ap12_surrogate": sql(_rounded("ap_ranker", ["ap"])),
    "e_map12_surrogate": sql("SELECT window_start, round(avg(ap), 6) AS map, count(*) AS n_purchasers FROM ap_ranker GROUP BY window_start"),
    "e_oracle_ap": sql(_rounded("ap_oracle", ["ap"])),
    "e_orderings_surrogate": sql("SELECT ordering, bucket AS recency_bucket, round(avg(ap), 6) AS map, count(*) AS n_purchasers FROM (SELECT ordering, ap, unnest(['all', recency_bucket]) AS bucket FROM (" + " UNION ALL ".join(f"SELECT *, '{n}' AS ordering FROM ap_{n}" for n in ("ranker", "popularity", "pool", "oracle")) + ") LEFT JOIN recency USING (window_start, customer_id)) GROUP BY ordering, bucket"),
    "e_backtest_pool_order": sql("SELECT window_start, round(avg(ap), 6) AS map, count(*) AS n_purchasers FROM ap_pool GROUP BY window_start", BACK),
    "m_category_mapping": sql(_mapping("matrix"), *TRAIN, pool="labelled"),
    "m_encoded": _encoded(),
    "m_group_sizes": sql("SELECT window_start, customer_id, count(*) AS n FROM labelled GROUP BY ALL", *TRAIN),
    "m_score_distribution_surrogate": sql("SELECT label, CAST(least(79, floor((p_purchase - low) / (high - low) * 80)) AS BIGINT) AS bin, count(*) AS n FROM surrogate, (SELECT min(p_purchase) AS low, max(p_purchase) AS high FROM surrogate) GROUP BY ALL"),
    "m_score_summary_surrogate": sql("SELECT label, count(*) AS n, round(avg(p_purchase), 6) AS mean, " + ", ".join(f"round(quantile_cont(p_purchase, {q}), 6) AS {n}" for q, n in ((0.01, "p01"), (0.5, "p50"), (0.99, "p99"))) + " FROM surrogate GROUP BY label"),
    "m_top12_surrogate": sql(f"SELECT {PRICE_KEYS}, rank_position, ranker_score FROM ranked"),
    "k_buckets": sql("SELECT customer_id, b AS bucket, b < 20 AS in_fit, b >= 20 AND b < 40 AS in_eval FROM (SELECT customer_id, CAST(('0x' || substr(md5('42:' || customer_id), 1, 8)) AS BIGINT) % 100 AS b FROM customers)"),
    "k_brier_surrogate": sql("SELECT n, round(base_rate, 9) AS base_rate, round(brier, 9) AS brier, round(1 - CASE WHEN base_rate * (1 - base_rate) <> 0 THEN brier / (base_rate * (1 - base_rate)) END, 9) AS brier_skill FROM (SELECT count(*) AS n, avg(label) AS base_rate, avg((p_purchase - label) ** 2) AS brier FROM surrogate)"),
    "k_quantile_bins_surrogate": sql(f"SELECT customer_id, article_id, bin FROM ({_bins('surrogate')})"),
    "k_reliability_surrogate": sql(f"SELECT bin, count(*) AS n, round(avg(p_purchase), 6) AS mean_predicted, round(avg(label), 6) AS observed_rate FROM ({_bins('surrogate', 'bucket >= 20 AND bucket < 40')}) GROUP BY bin"),
    "k_top_bin_surrogate": sql(f"SELECT bin, count(*) AS n, round(avg(p_purchase), 6) AS mean_predicted, round(avg(label), 6) AS observed_rate, round(max(base_rate), 6) AS base_rate, round(CASE WHEN max(base_rate) <> 0 THEN avg(label) / max(base_rate) END, 6) AS lift FROM ({_bins(f'(SELECT * EXCLUDE bin FROM ({_bins("surrogate")}) WHERE bin = 9)')}), (SELECT avg(label) AS base_rate FROM surrogate) GROUP BY bin"),
    "n_recently_sold": sql("SELECT * FROM sold"),
    "n_recently_bought": sql("SELECT * FROM bought"),
    "n_trailing_price": sql(_rounded("prices", ["price"], 4)),
    "n_contact_cost": sql(_rounded("cost", ["median_price", "contact_cost"], 4)),
    "n_expected_value_surrogate": sql("SELECT customer_id, article_id, rank_position, eligible, round(expected_value, 4) AS expected_value FROM scored12"),
    "n_offers_surrogate": sql("SELECT customer_id, article_id, round(expected_value, 4) AS expected_value, ranker_score, rank_position, round(p_purchase, 4) AS p_purchase, round(price, 4) AS price, bucket FROM selected"),
    "n_coverage_surrogate": sql("SELECT (SELECT count(DISTINCT customer_id) FROM selected) AS covered, count(DISTINCT customer_id) AS total, round((SELECT count(DISTINCT customer_id) FROM selected) / count(DISTINCT customer_id), 6) AS coverage FROM customers"),
    "n_concentration_surrogate": sql("SELECT count(*) AS distinct_articles, CAST(coalesce(sum(n), 0) AS BIGINT) AS selections, round(coalesce(sum(n) FILTER (k <= 10) / sum(n), 0.0), 6) AS top_share FROM (SELECT article_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, article_id) AS k FROM selected GROUP BY article_id)"),
    "n_strategy_mix_surrogate": sql("SELECT " + ", ".join(f"round(coalesce(avg(CAST(rank_{s} IS NOT NULL AS INTEGER)), 0.0), 6) AS {s}" for s in SQL_STRATEGIES) + " FROM selected"),
    "n_divergence_surrogate": sql("SELECT count(*) AS offers, count(*) FILTER (s.article_id <> t.article_id) AS different, round(count(*) FILTER (s.article_id <> t.article_id) / count(*), 6) AS share FROM selected s LEFT JOIN top1 t USING (customer_id)"),
    "n_price_summary_surrogate": sql(" UNION ALL ".join(f"SELECT '{n}' AS what, " + ", ".join(f"round(quantile_cont(price, {q / 100}), 4) AS p{q}" for q in (10, 25, 50, 75, 90)) + f", round(avg(price), 4) AS mean FROM {t}" for n, t in (("offers", "selected"), ("top1", "top1")))),
    "n_sensitivity_surrogate": sql(GRID),
    "n_in_sample_surrogate": sql("SELECT count(*) AS covered, count(*) FILTER (bucket < 20) AS in_fit, round(count(*) FILTER (bucket < 20) / count(*), 6) AS share FROM selected"),
    "n_divergence_parts_surrogate": sql("SELECT count(*) AS different, count(*) FILTER (b) AS bought_lately, count(*) FILTER (NOT b AND NOT s) AS not_sold_lately, count(*) FILTER (NOT b AND s) AS worth_less, round(quantile_cont(CASE WHEN NOT b AND s AND first_price <> 0 THEN price / first_price END, 0.5), 6) AS median_price_ratio FROM (SELECT o.price, t.price AS first_price, EXISTS (SELECT 1 FROM bought x WHERE x.customer_id = t.customer_id AND x.article_id = t.article_id) AS b, EXISTS (SELECT 1 FROM sold y WHERE y.article_id = t.article_id) AS s FROM selected o JOIN top1 t ON t.customer_id = o.customer_id AND t.article_id <> o.article_id)"),
    "n_thresholds_surrogate": sql(_thresholds()),
    "n_offer_summary_surrogate": sql("SELECT article_id, count(*) AS selections, round(max(price), 4) AS price FROM selected GROUP BY article_id ORDER BY count(*) DESC, article_id LIMIT 10"),
    "s_store_surrogate": sql(_rounded("store", ["p_purchase", "price", "expected_value"], 4)),
    "s_unmatched_surrogate": sql("SELECT customer_id, article_id FROM ranked WHERE (customer_id, article_id) NOT IN (SELECT (customer_id, article_id) FROM pool WHERE n_strategies > 1)"),
    "s_recommend_surrogate": sql("SELECT customer_id, string_agg(article_id, ',' ORDER BY rank) FILTER (rank <= 5) AS items, max(article_id) FILTER (selected) AS offer FROM store GROUP BY customer_id"),
    "s_sample_store_surrogate": sql(_rounded("(SELECT * FROM store WHERE customer_id IN (SELECT customer_id FROM (SELECT customer_id, row_number() OVER (PARTITION BY recency_bucket ORDER BY sha256('42:' || customer_id), customer_id) AS k FROM recency) WHERE k <= 300)) AS chosen", ["p_purchase", "price", "expected_value"], 4)),
    "s_sampled": sql("SELECT recency_bucket, customer_id, key FROM (SELECT recency_bucket, customer_id, sha256('42:' || customer_id) AS key, row_number() OVER (PARTITION BY recency_bucket ORDER BY sha256('42:' || customer_id), customer_id) AS k FROM recency) WHERE k <= 300"),
    "g_not_exact_surrogate": sql("SELECT customer_id, count(*) AS n FROM scored12 WHERE eligible GROUP BY customer_id HAVING count(*) <> 12"),
    "g_customer_count": sql("SELECT count(*) AS n FROM customers"),
    "r_psi": _with_psi("SELECT column_name, round(psi, 6) AS psi FROM psi"),
    "r_verdict": _with_psi(f"SELECT features, drifted, probability_drifted, round(drifted / features, 6) AS share, NOT (drifted / features > 0.25 OR probability_drifted) AS passed FROM (SELECT count(*) FILTER (column_name <> '{drift.PROBABILITY}') AS features, count(*) FILTER (column_name <> '{drift.PROBABILITY}' AND psi >= 0.25) AS drifted, bool_or(column_name = '{drift.PROBABILITY}' AND psi >= 0.25) AS probability_drifted FROM psi)"),
    "r_reference": sql(f"SELECT {PRICE_KEYS} FROM pool ORDER BY md5('{drift.SEED}:' || customer_id || ':' || article_id), customer_id, article_id LIMIT {drift.SAMPLE}", BACK),
    "r_unmatched": sql(f"SELECT {PRICE_KEYS} FROM pool WHERE CAST(('0x' || substr(md5('{drift.SEED}:' || customer_id || ':' || article_id), 1, 8)) AS BIGINT) % 1000 = 0"),
    "r_matched": sql(f"SELECT {PRICE_KEYS}, CAST(label AS BIGINT) AS label FROM labelled WHERE CAST(('0x' || substr(md5('{drift.SEED}:' || customer_id), 1, 8)) AS BIGINT) % 4 = 0", *TRAIN),
    "x_per_customer": sql(f"SELECT {_points('min p25 median p75 p90 p99 max')}, round(avg(n), 6) AS mean FROM (SELECT count(*) AS n FROM tx GROUP BY customer_id)"),
    "x_per_article": sql(f"SELECT {_points('min p25 median p75 p90 p99 max')}, round(avg(n), 6) AS mean FROM (SELECT count(*) AS n FROM tx GROUP BY article_id)"),
    "x_top_share": sql("SELECT percent, round(sum(n) FILTER (k <= greatest(1, floor(articles * percent / 100 + 0.5))) / sum(n), 6) AS share FROM (SELECT count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, article_id) AS k, count(*) OVER () AS articles FROM tx GROUP BY article_id), (SELECT unnest([1, 5, 10]) AS percent) GROUP BY percent"),
    "x_lorenz": sql("SELECT article_id, round(k / articles, 6) AS article_share, round(below / total, 6) AS purchase_share FROM (SELECT article_id, row_number() OVER (ORDER BY n DESC, article_id) AS k, count(*) OVER () AS articles, sum(n) OVER (ORDER BY n DESC, article_id) AS below, sum(n) OVER () AS total FROM (SELECT article_id, count(*) AS n FROM tx GROUP BY article_id))"),
    "x_weekly_volume": sql("SELECT CAST(date_trunc('week', t_dat) AS DATE) AS week, count(*) AS n FROM tx GROUP BY ALL"),
    "x_repurchase_rate": sql("SELECT week, count(*) AS n, CAST(sum(again) AS BIGINT) AS again, round(avg(again), 6) AS rate FROM (SELECT unnest([CAST(date_trunc('week', t_dat) AS DATE), NULL]) AS week, again FROM (SELECT t_dat, CAST(row_number() OVER (PARTITION BY customer_id, article_id ORDER BY t_dat) > 1 AS INTEGER) AS again FROM tx)) GROUP BY week"),
    "x_recency_counts": sql(f"SELECT CAST(list_position(['<=1 week', '<=4 weeks', '<=12 weeks', '<=52 weeks', '>52 weeks', 'never'], recency_bucket) AS BIGINT) AS place, recency_bucket, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ({LAST}) GROUP BY recency_bucket"),
    "x_recency_cumulative": sql("SELECT " + ", ".join(f"count(*) FILTER (d <= {7 * w}) AS within_{w}w" for w in (1, 4, 12, 52)) + ", count(*) FILTER (d > 364) AS beyond FROM (SELECT date_diff('day', max(t_dat), (SELECT max(t_dat) FROM tx)) AS d FROM tx GROUP BY customer_id)"),
    "x_lifecycle": sql(f"SELECT {_points('min p25 median p75 p90 max')}, round(avg(n), 6) AS mean, count(*) AS articles FROM (SELECT date_diff('day', min(t_dat), max(t_dat)) AS n FROM tx GROUP BY article_id)"),
    "x_new_in_window": sql(f"SELECT count(*) AS sold, count(*) FILTER (first >= {W} - 28) AS new, round(count(*) FILTER (first >= {W} - 28) / count(*), 6) AS share FROM (SELECT article_id, min(t_dat) AS first FROM tx GROUP BY article_id) WHERE article_id IN (SELECT article_id FROM tx WHERE t_dat >= {W} AND t_dat < {W} + 7)"),
    "x_ages": sql("SELECT count(*) AS n, count(age) AS known, CAST(min(age) AS BIGINT) AS min, round(quantile_cont(age, 0.5), 6) AS median, round(avg(age), 6) AS mean, CAST(max(age) AS BIGINT) AS max, round(1 - count(age) / count(*), 6) AS null_rate FROM customers"),
    "x_mix": sql("SELECT index_group_name, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM tx LEFT JOIN articles USING (article_id) GROUP BY index_group_name"),
    "x_pool_sizes": sql(f"SELECT count(*) AS customers, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, {_points('min p25 median p75 max')} FROM (SELECT customer_id, count(*) AS n FROM pool GROUP BY customer_id)"),
    "x_popularity_only": sql("SELECT count(*) AS customers, count(*) FILTER (NOT own) AS popularity_only FROM (SELECT customer_id, bool_or(list_has_any(strategies, ['repurchase', 'colour_variant', 'als'])) AS own FROM pool GROUP BY customer_id)"),
    "x_sensitivity_pivot": sql("SELECT margin, " + ", ".join(f"max(coverage) FILTER (multiplier = {m / 10000!r}) AS m_{m}" for m in offers.MULTIPLIERS) + f" FROM ({GRID}) GROUP BY margin"),
}

#: Date columns of the results, which both sides give as text.
DATES: dict[str, tuple[str, ...]] = {
    **dict.fromkeys(
        (
            "d_actual_purchases d_training_labels c_repurchase c_colour_variant c_recent_top c_recent_popularity c_segment_top c_segment_popularity c_pool c_without_candidates c_cap_sweep "
            "f_customer f_article f_recent_text f_pair f_provenance f_assembled f_backtest f_training_matrix e_recall e_over_limit e_recall_report e_training_recall e_recency_buckets "
            "e_ap12_surrogate e_map12_surrogate e_oracle_ap e_backtest_pool_order m_encoded m_group_sizes m_top12_surrogate r_reference r_unmatched r_matched"
        ).split(),
        ("window_start",),
    ),
    "d_label_windows": ("window_start", "window_end"),
    "d_history": ("t_dat",),
    "x_weekly_volume": ("week",),
    "x_repurchase_rate": ("week",),
}
ORACLES |= {n: f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in columns)}) FROM (\n{ORACLES[n]}\n)" for n, columns in DATES.items()}
# values rounded to four digits are prices, whose ties are decided as the queries do
ORACLES = {n: q.replace(", 4) AS ", f" + {NUDGE!r}, 4) AS ") for n, q in ORACLES.items()}
