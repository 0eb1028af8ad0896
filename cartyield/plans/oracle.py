"""The queries of ``queries.py`` as DuckDB SQL, written from the definitions.

Mining is checked against an unpruned walk over all subsets of every receipt, so the SQL shares
neither bounds nor levels with the Spark jobs.
"""

from __future__ import annotations

from . import queries as q

# The item pool, as in the generator.
from ..sources.generate import ITEM_POOL, MAX_BASKET, MAX_QUANTITY

_PLACE = f"l_linenumber::BIGINT * {q.LINE_STEP} + l_partkey"
_CENTS = "round(l_extendedprice * 100)::BIGINT"
_JOINED = "lineitem JOIN part ON l_partkey = p_partkey"

BRAND_ITEMS = f"""items AS (
  SELECT l_orderkey AS tid, {_PLACE} AS pos, p_brand AS item, l_quantity::BIGINT AS quantity,
         p_retailprice AS profit, {_CENTS} AS utility
  FROM {_JOINED})"""


def keyed_items(key: str) -> str:
    return f"""items AS (
  SELECT l_orderkey AS tid, {_PLACE} AS pos, {key}::VARCHAR AS item, {_CENTS} AS utility
  FROM lineitem)"""


SOLD_ITEMS = f"""sold AS (
  SELECT l_orderkey AS tid, {_PLACE} AS pos, p_brand AS item, l_quantity::BIGINT AS quantity,
         p_retailprice::DECIMAL(18,4) AS profit,
         l_quantity::BIGINT * p_retailprice::DECIMAL(18,4) AS utility
  FROM {_JOINED}),
tokens AS (
  SELECT *, item || ':' || quantity || ':' || rtrim(rtrim(profit::VARCHAR, '0'), '.') AS token
  FROM sold),
totals AS (SELECT tid, sum(utility)::DECIMAL(28,4) AS total_utility FROM sold GROUP BY tid),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY tid ORDER BY pos, token) - 1)::INT AS place
  FROM tokens JOIN totals USING (tid))"""

MERGED = """merged AS (
  SELECT tid, item, sum(utility)::BIGINT AS utility, min(pos) AS pos FROM items GROUP BY tid, item)"""

TWU = f"""{MERGED},
receipts AS (
  SELECT tid, sum(greatest(utility, 0))::BIGINT AS total FROM merged GROUP BY tid),
twu AS (
  SELECT item, sum(total)::BIGINT AS twu, count(*) AS occurrences
  FROM merged JOIN receipts USING (tid) GROUP BY item)"""

MEAN_LIMIT = "m AS (SELECT (sum(twu) // count(*))::BIGINT AS m FROM twu)"


def share_limit(share: int = q.SHARE) -> str:
    return f"m AS (SELECT (sum(greatest(utility, 0)) // {share})::BIGINT AS m FROM items)"


RANKS = """ranks AS (
  SELECT item, twu, row_number() OVER (ORDER BY twu, item) AS rank
  FROM twu WHERE twu >= (SELECT m FROM m))"""


def lists(order: str, gain: str = "utility") -> str:
    return f"""ul AS (
  SELECT tid, item, rank, utility AS iu, coalesce(sum({gain}) OVER (
           PARTITION BY tid ORDER BY {order}
           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)::BIGINT AS ru
  FROM merged JOIN ranks USING (item))"""


SUMS = """sums AS (
  SELECT item, sum(iu)::BIGINT AS sum_iu, sum(ru)::BIGINT AS sum_ru,
         sum(greatest(iu + ru, 0))::BIGINT AS upper_bound, count(*) AS transactions
  FROM ul GROUP BY item)"""


def walk(step: str) -> str:
    """Every subset of every receipt; ``step`` is the utility after adding item x."""
    return f"""walk(tid, r, path, its, u1, iu, ru) AS (
  SELECT tid, rank, [rank], [item], iu, iu, ru FROM ul
  UNION ALL
  SELECT w.tid, x.rank, list_append(w.path, x.rank), list_append(w.its, x.item), w.u1, {step}, x.ru
  FROM walk w JOIN ul x ON x.tid = w.tid AND x.rank > w.r),
agg AS (
  SELECT path, any_value(its) AS its, sum(iu)::BIGINT AS utility,
         sum(greatest(iu + ru, 0))::BIGINT AS bound, count(*) AS transactions, len(path) AS size
  FROM walk GROUP BY path)"""


# An itemset is reached if none of its proper prefixes is cut off.
PREFIXES_KEPT = """cut AS (SELECT path FROM agg WHERE bound < (SELECT m FROM m)),
candidates AS (SELECT * FROM agg WHERE utility >= (SELECT m FROM m)),
prefixes AS (
  SELECT path, path[1:i] AS prefix
  FROM candidates, unnest(range(1, size)) AS t(i)),
reached AS (
  SELECT * FROM candidates WHERE path NOT IN (
    SELECT p.path FROM prefixes p JOIN cut ON cut.path = p.prefix))"""

_NAME = "'{' || array_to_string(list_sort(its), ', ') || '}'"


def shaped(source: str) -> str:
    return f"""found AS (
  SELECT list_sort(its) AS itemset, {_NAME} AS itemset_name, utility, size::INT AS size, transactions
  FROM {source} WHERE utility >= (SELECT m FROM m))"""


def exact(items: str, share: int = q.SHARE, limit: str | None = None) -> str:
    ctes = [items, TWU, limit or share_limit(share), RANKS, lists("rank", "greatest(utility, 0)")]
    return "WITH RECURSIVE " + ",\n".join([*ctes, walk("w.iu + x.iu"), shaped("agg")])


def endpoints(
    items: str, share: int = q.SHARE, limit: str | None = None, twu: str = TWU, kept: str = PREFIXES_KEPT
) -> str:
    ctes = [items, twu, limit or share_limit(share), RANKS, lists("pos"), walk("w.u1 + x.iu")]
    return "WITH RECURSIVE " + ",\n".join([*ctes, kept, shaped("reached")])


# Every itemset the search arrives at, not only results.
ALL_KEPT = PREFIXES_KEPT.replace("FROM agg WHERE utility >= (SELECT m FROM m)", "FROM agg")
STATED_ITEMS = f"""{BRAND_ITEMS},
stated AS (
  SELECT o_orderkey AS tid, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN NULL
         ELSE round(o_totalprice * 100)::BIGINT END AS stated FROM orders)"""
STATED_TWU = TWU.replace(
    "SELECT tid, sum(greatest(utility, 0))::BIGINT AS total FROM merged GROUP BY tid",
    "SELECT tid, coalesce(nullif(max(stated), 0), sum(utility))::BIGINT AS total"
    " FROM merged LEFT JOIN stated USING (tid) GROUP BY tid",
)
# Receipts read from text have amounts of four decimals.
TEXT_ITEMS = f"""{SOLD_ITEMS},
items AS (SELECT tid, place AS pos, item, (utility * 10000)::BIGINT AS utility FROM numbered)"""
TEXT_LIMIT = f"m AS (SELECT (sum(utility) // 10000 // {q.SHARE} * 10000)::BIGINT AS m FROM items)"
TEXT_FLAT = "SELECT itemset_name, utility / 10000 AS utility, size, transactions FROM found"
# The receipt of all parts adds one cent per item to whatever other receipts hold.
LONG = f"""agg_long AS (
  SELECT its, utility + size AS utility, transactions + 1 AS transactions, size FROM agg),
{shaped("agg_long")}"""

# Where only the ends of an itemset count, it adds two cents, and to the bound also what is printed after the last item. The SQL walks
# the other receipts and adds that to whatever is found there; by itself the long receipt reaches no threshold.
LONG_ITEMS = f"""{keyed_items("l_partkey")},
every AS (
  SELECT * FROM items
  UNION ALL SELECT -1, p_partkey, p_partkey::VARCHAR, 1 FROM part)"""
LONG_ENDS = """agg AS (
  SELECT path, its, a.utility + least(size, 2) AS utility, a.transactions + 1 AS transactions, size,
         bound + least(size, 2) + ru AS bound
  FROM agg_orders a JOIN (SELECT rank, ru FROM ul WHERE tid = -1) ON rank = path[size])"""


def endpoints_long() -> str:
    """All but the threshold looks at every receipt; only orders are walked."""
    query = endpoints(LONG_ITEMS, q.LONG_SHARE, twu=TWU.replace("FROM items GROUP BY tid, item", "FROM every GROUP BY tid, item"))
    query = query.replace("SELECT tid, rank, [rank], [item], iu, iu, ru FROM ul", "SELECT tid, rank, [rank], [item], iu, iu, ru FROM ul WHERE tid <> -1")
    query = query.replace("agg AS (", "agg_orders AS (", 1).replace("sum(greatest(iu + ru, 0))::BIGINT AS bound", "sum(iu + ru)::BIGINT AS bound")
    return query.replace(PREFIXES_KEPT, f"{LONG_ENDS},\n{PREFIXES_KEPT}")


LOSS_ITEMS = BRAND_ITEMS.replace("AS utility", f"- {q.LINE_COST} AS utility")
MINED = exact(BRAND_ITEMS)
FLAT = "SELECT itemset_name, utility, size, transactions FROM found"
_ORDER = "ORDER BY utility DESC, itemset_name"
_PARTS = keyed_items("l_partkey")
_BRAND_TWU = f"WITH {BRAND_ITEMS},\n{TWU}"
_PART_TWU = f"WITH {_PARTS},\n{TWU},\n{MEAN_LIMIT}"
_BRAND_LISTS = f"{_BRAND_TWU},\n{share_limit()},\n{RANKS},\n{lists('pos')}"
_PART_LISTS = f"{_PART_TWU},\n{RANKS},\n{lists('rank', 'greatest(utility, 0)')}"
_FLAG_TWU = f"WITH {_PARTS.replace('l_orderkey AS tid', 'l_returnflag AS tid')},\n{TWU},\n{MEAN_LIMIT}"
_PROMISING = "(SELECT item FROM twu WHERE twu >= (SELECT m FROM m))"
_A, _B, _C = q.NAMES
_LOSS_SUMS = f"""WITH {LOSS_ITEMS},
{TWU},
{share_limit()},
{RANKS},
{lists('rank', 'greatest(utility, 0)')},
{SUMS}"""


def counters(extendable: str) -> str:
    return f"""(SELECT count(*) FROM twu) AS twu_candidates, (SELECT count(*) FROM ranks) AS promising_items,
       (SELECT sum(occurrences)::BIGINT FROM twu JOIN ranks USING (item)) AS estimated_utility_entries,
       (SELECT count(*) FROM ranks) AS utility_lists_built,
       ((SELECT count(*) FROM ranks) + (SELECT sum((SELECT count(*) FROM ranks) - last)
          FROM (SELECT path[-1] AS last FROM {extendable} WHERE bound >= (SELECT m FROM m))))::BIGINT
         AS dfs_nodes_explored,
       (SELECT count(*) FROM found) AS huis_found,
       (SELECT count(*) FROM receipts) AS total_transactions"""


def _draw(digest: str, part: int) -> str:
    return f"('0x' || substr({digest}, {1 + 8 * part}, 8))::BIGINT"


def _between(number: str, low: str, high: str) -> str:
    return f"({low} + (({number} * ({high} - {low} + 1)) >> 32))"


_POOL = ", ".join(f"('{n}', {round(lo * 100)}, {round(hi * 100)})" for n, lo, hi in ITEM_POOL)

GENERATED = f"""WITH pool(item, low, high) AS (VALUES {_POOL}),
drawn AS (
  SELECT o_orderkey AS tid, item, low, high, md5('42/' || o_orderkey || '/' || item) AS digest,
         {_between(_draw("md5('42/' || o_orderkey)", 0), "1", str(MAX_BASKET))} AS size
  FROM orders, pool),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY tid ORDER BY digest) - 1)::INT AS pos FROM drawn),
lines AS (
  SELECT tid, pos, item, {_between(_draw("digest", 1), "1", str(MAX_QUANTITY))}::BIGINT AS quantity,
         {_between(_draw("digest", 2), "low", "high")}::BIGINT AS cents
  FROM placed WHERE pos < size)
SELECT tid, pos, item, quantity, (cents / 100)::DOUBLE AS profit,
       (quantity * cents)::BIGINT / 100 AS utility,
       (sum(quantity * cents) OVER (PARTITION BY tid))::BIGINT / 100 AS total_utility
FROM lines"""


def oracle_sql() -> dict[str, str]:
    return {
        "parse_transactions": f"""WITH {SOLD_ITEMS}
SELECT tid, place AS pos, item, quantity, profit::DOUBLE AS profit, utility::DOUBLE AS utility,
       total_utility::DOUBLE AS total_utility FROM numbered""",
        "read_transactions": f"""WITH {SOLD_ITEMS}
SELECT place AS pos, item, quantity, profit::DOUBLE AS profit,
       total_utility::DOUBLE AS total_utility, count(*) AS lines, count(DISTINCT tid) AS receipts
FROM numbered GROUP BY ALL""",
        "file_tids": f"""WITH {SOLD_ITEMS}
SELECT 0::BIGINT AS first, count(DISTINCT tid) - 1 AS last, count(DISTINCT tid) AS receipts,
       (count(DISTINCT tid) * (count(DISTINCT tid) - 1) // 2)::BIGINT AS sum_of_ids, count(*) AS lines FROM numbered""",
        "dense_tid": """SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) - 1 AS tid
FROM (SELECT DISTINCT l_orderkey FROM lineitem)""",
        "transaction_totals": f"""WITH {BRAND_ITEMS}
SELECT tid, coalesce(nullif(CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN NULL
         ELSE round(o_totalprice * 100)::BIGINT END, 0), added)::BIGINT AS total_utility
FROM (SELECT tid, sum(utility) AS added FROM items GROUP BY tid)
LEFT JOIN orders ON o_orderkey = tid""",
        "explode_items": f"WITH {BRAND_ITEMS} SELECT * FROM items",
        "render_transactions": f"""WITH {SOLD_ITEMS}
SELECT tid, string_agg(token, ' ' ORDER BY place) || ' :'
         || rtrim(rtrim(any_value(total_utility)::VARCHAR, '0'), '.') AS value
FROM numbered GROUP BY tid""",
        "generate_transactions": GENERATED,
        "item_utility": f"""SELECT l_orderkey, l_linenumber, l_partkey,
       l_quantity * p_retailprice AS utility FROM {_JOINED}""",
        "item_lookup": f"""WITH {BRAND_ITEMS},
first AS (SELECT tid, arg_min(struct_pack(quantity, profit, utility), pos) AS line
          FROM items WHERE item = '{_A}' GROUP BY tid)
SELECT tid, line.quantity AS quantity, line.profit AS profit, line.utility AS utility
FROM (SELECT DISTINCT tid FROM items) LEFT JOIN first USING (tid)""",
        "item_utility_or_zero": f"""WITH {BRAND_ITEMS},
first AS (SELECT tid, arg_min(utility, pos) AS utility FROM items WHERE item = '{_A}' GROUP BY tid)
SELECT tid, coalesce(utility, 0)::BIGINT AS utility
FROM (SELECT DISTINCT tid FROM items) LEFT JOIN first USING (tid)""",
        "contains_all": f"""WITH {BRAND_ITEMS}
SELECT tid FROM items WHERE item IN ('{_A}', '{_B}') GROUP BY tid HAVING count(DISTINCT item) = 2""",
        "contains_lists": f"""WITH {BRAND_ITEMS},
lists AS (SELECT DISTINCT p_partkey - k AS list_id, p_brand AS item FROM part, range(3) r(k)),
sizes AS (SELECT list_id, count(*) AS size FROM lists GROUP BY list_id),
held AS (SELECT DISTINCT tid, item FROM items),
shared AS (SELECT list_id, tid, count(*) AS n FROM lists JOIN held USING (item) GROUP BY list_id, tid)
SELECT list_id, tid FROM shared JOIN sizes USING (list_id) WHERE n = size""",
        "remaining_after": f"""WITH {BRAND_ITEMS},
last AS (SELECT tid, max(pos) AS last FROM (
           SELECT tid, item, min(pos) AS pos FROM items WHERE item IN ('{_A}', '{_B}')
           GROUP BY tid, item) GROUP BY tid)
SELECT tid, coalesce(sum(utility) FILTER (pos > last), 0)::BIGINT AS remaining
FROM items LEFT JOIN last USING (tid) GROUP BY tid""",
        "twu": f"{_BRAND_TWU} SELECT item, twu FROM twu",
        "twu_stated": f"""WITH {BRAND_ITEMS}
SELECT item, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS twu
FROM (SELECT DISTINCT tid, item FROM items) JOIN orders ON o_orderkey = tid GROUP BY item""",
        "twu_contributions": f"""{_BRAND_TWU}
SELECT tid, item, total AS twu FROM merged JOIN receipts USING (tid)""",
        "twu_merge": f"{_BRAND_TWU} SELECT item, twu FROM twu",
        "twu_in_drops": f"""WITH {SOLD_ITEMS}
SELECT item, sum(total_utility)::DOUBLE AS twu FROM (SELECT DISTINCT tid, item, total_utility FROM numbered) GROUP BY item""",
        "promising_items": f"{_PART_TWU} SELECT item, twu FROM twu WHERE twu >= (SELECT m FROM m)",
        "item_rank": f"{_PART_TWU}, {RANKS} SELECT item, twu, rank::INT AS rank FROM ranks",
        "promising_transactions": f"""{_PART_TWU},
kept AS (SELECT * FROM items WHERE item IN {_PROMISING})
SELECT tid, pos, item, utility, (sum(utility) OVER (PARTITION BY tid))::BIGINT AS total_utility
FROM kept""",
        "item_occurrences": f"""{_PART_TWU}
SELECT item, occurrences FROM twu WHERE item IN {_PROMISING}""",
        "estimated_entries": f"""{_PART_TWU}
SELECT sum(occurrences)::BIGINT AS estimated_entries FROM twu WHERE item IN {_PROMISING}""",
        "suggest_min_util": f"""{_PART_TWU},
kept AS (SELECT * FROM twu WHERE item IN {_PROMISING}),
running AS (SELECT twu, sum(occurrences) OVER (ORDER BY twu DESC, item) AS running FROM kept)
SELECT coalesce(max(twu) + 1, (SELECT m FROM m))::BIGINT AS min_util FROM running
WHERE running > (SELECT sum(occurrences) // {q.ENTRY_BUDGET_SHARE} FROM kept)""",
        "utility_list_position": f"{_BRAND_LISTS} SELECT tid, item, iu, ru, iu + ru AS total FROM ul",
        "utility_list_twu": f"{_PART_LISTS} SELECT tid, item, rank::INT AS rank, iu, ru FROM ul",
        "utility_list_long": f"""{_FLAG_TWU},\n{RANKS},\n{lists('rank', 'greatest(utility, 0)')}
SELECT tid, item, rank::INT AS rank, iu, ru FROM ul""",
        "item_bounds": f"{_BRAND_LISTS}, {SUMS} SELECT * FROM sums",
        "extendable_items": f"""{_PART_LISTS}, {SUMS}
SELECT * FROM sums WHERE upper_bound >= (SELECT m // {q.BOUND_SHARE} FROM m)""",
        "prunable_items": f"""{_PART_LISTS}, {SUMS}
SELECT * FROM sums WHERE upper_bound < (SELECT m // {q.BOUND_SHARE} FROM m)""",
        "empty_prefix_list": f"""{_BRAND_LISTS}
SELECT tid, 0::BIGINT AS iu, iu + ru AS ru FROM ul WHERE item = '{_A}'""",
        "pair_utility_list": f"""{_BRAND_LISTS}
SELECT a.tid, a.iu + b.iu + c.iu AS iu, c.ru FROM ul a JOIN ul b USING (tid) JOIN ul c USING (tid)
WHERE a.item = '{_A}' AND b.item = '{_B}' AND c.item = '{_C}'""",
        "mine_exact": f"{MINED} {FLAT}",
        "mine_endpoints": f"{endpoints(BRAND_ITEMS)} {FLAT}",
        "mine_exact_suppliers": f"{exact(keyed_items('l_suppkey'), q.SUPPLIER_SHARE)} {FLAT}",
        "mine_endpoints_suppliers": f"""{endpoints(keyed_items('l_suppkey'), q.SUPPLIER_SHARE)}
{FLAT}""",
        "mine_exact_losses": f"{exact(LOSS_ITEMS)} {FLAT}",
        "top_k_mining": f"""{exact(BRAND_ITEMS, limit='m AS (SELECT 1::BIGINT AS m)')} {FLAT} {_ORDER} LIMIT {q.TOP}""",
        "mine_stats": f"{MINED} SELECT {counters('agg')}",
        "mine_stats_endpoints": f"{endpoints(BRAND_ITEMS, kept=ALL_KEPT)} SELECT {counters('reached')}",
        "mine_endpoints_stated": f"{endpoints(STATED_ITEMS, twu=STATED_TWU)} {FLAT}",
        "mine_exact_long": f"""{exact(_PARTS, q.LONG_SHARE).replace(shaped("agg"), LONG)} {FLAT}""",
        "mine_endpoints_long": f"{endpoints_long()} {FLAT}",
        "run_text": f"{exact(TEXT_ITEMS, limit=TEXT_LIMIT)} {TEXT_FLAT}",
        "run_text_endpoints": f"{endpoints(TEXT_ITEMS, limit=TEXT_LIMIT)} {TEXT_FLAT}",
        "run_text_counters": f"""{exact(TEXT_ITEMS, limit=TEXT_LIMIT)}
SELECT {counters('agg')}, (SELECT count(*) FROM found) AS itemsets,
       (SELECT max(size) FROM found) AS max_size,
       (SELECT count(*) FROM found WHERE size = 1) AS single_items,
       (SELECT count(*) FROM found WHERE size = 2) AS pairs,
       (SELECT count(*) FROM found WHERE size > 2) AS larger,
       (SELECT max(utility) / 10000 FROM found) AS max_utility""",
        "item_bounds_losses": f"{_LOSS_SUMS} SELECT * FROM sums",
        "prunable_items_losses": f"""{_LOSS_SUMS}
SELECT * FROM sums WHERE upper_bound < (SELECT sum(upper_bound) // count(*) FROM sums)""",
        "result_document": f"""{MINED},
stats AS (SELECT {counters('agg')}),
summary AS (
  SELECT count(*) AS count, max(utility) AS max_utility, min(utility) AS min_utility,
         max(size) AS max_size, count(*) FILTER (size = 1) AS single_items,
         count(*) FILTER (size = 2) AS pairs, count(*) FILTER (size > 2) AS larger FROM found),
placed AS (SELECT row_number() OVER ({_ORDER}) AS place, * FROM found)
SELECT 0::BIGINT AS place,
       '{{"success":true,"mode":"exact","min_util":' || (SELECT m FROM m) || ',"itemsets":[' AS json
UNION ALL
SELECT place, CASE WHEN place > 1 THEN ',' ELSE '' END
       || to_json(struct_pack(itemset, itemset_name, utility, size, transactions))::VARCHAR FROM placed
UNION ALL
SELECT 9223372036854775807, '],"total_transactions":' || total_transactions || ',"huis_found":' || count
       || ',"stats":' || to_json(summary)::VARCHAR || ',"algorithm_stats":' || to_json(stats)::VARCHAR || '}}'
FROM stats, summary""",
        "result_rows": f"""{MINED}
SELECT array_to_string(itemset, '|') AS itemset, itemset_name, utility::DOUBLE AS utility, size,
       transactions FROM found""",
        "sort_by_size": f"{MINED} {FLAT} ORDER BY size DESC, utility DESC, itemset_name",
        "top10": f"{MINED} {FLAT} {_ORDER} LIMIT 10",
        "search_itemsets": f"""{MINED} {FLAT}
WHERE contains(lower(itemset_name), lower('{q.SEARCH}'))""",
        "bar_percent": f"""{MINED}
SELECT itemset_name, utility, floor(utility::DOUBLE / greatest((SELECT max(utility) FROM found), 1)
         * 100 + 0.5)::BIGINT AS percent FROM found""",
        "summary_stats": f"""{MINED}
SELECT count(*) AS count, max(utility) AS max_utility, min(utility) AS min_utility,
       sum(utility)::DOUBLE / count(*) AS avg_utility, max(size) AS max_size,
       sum(size)::DOUBLE / count(*) AS avg_size, count(*) FILTER (size = 1) AS single_items,
       count(*) FILTER (size = 2) AS pairs, count(*) FILTER (size > 2) AS larger FROM found""",
        "size_distribution": f"""{MINED}
SELECT size_class, count(path) AS itemsets
FROM (VALUES ('single', 1), ('pair', 2), ('large', 3)) AS c(size_class, size)
LEFT JOIN (SELECT itemset_name AS path, least(size, 3) AS size FROM found) USING (size)
GROUP BY size_class""",
        "itemset_name": """SELECT p_partkey,
       '{' || array_to_string(list_sort([p_type, p_name, p_brand]), ', ') || '}' AS itemset_name
FROM part""",
        "size_class": """SELECT l_orderkey, count(*) AS size,
       CASE count(*) WHEN 1 THEN 'single' WHEN 2 THEN 'pair' ELSE 'large' END AS size_class
FROM lineitem GROUP BY l_orderkey""",
        "result_json": f"""{MINED}
SELECT to_json(struct_pack(itemset, itemset_name, utility, size, transactions))::VARCHAR AS json
FROM found""",
        "report_lines": f"""{MINED}
SELECT row_number() OVER ({_ORDER}) AS rank,
       '#' || row_number() OVER ({_ORDER}) || ' ' || itemset_name || chr(10)
       || '   Utilité totale : ' || utility || '.00MRU' || chr(10)
       || '   Taille : ' || size || ' article(s)' || chr(10)
       || '   Transactions : ' || transactions || chr(10) AS entry FROM found""",
        "ranked_export": f"""{MINED}
SELECT row_number() OVER ({_ORDER}) AS "Rang", itemset_name AS "Itemset",
       utility::DOUBLE AS "Utilite (MRU)", size AS "Taille", transactions AS "Transactions"
FROM found""",
        "result_rows_legacy": f"""{MINED}
SELECT itemset_name AS itemset, utility || '.00' AS utility_eur, size,
       array_to_string(itemset, ', ') AS items, (SELECT m FROM m)::DOUBLE AS min_util FROM found""",
        "csv_roundtrip": f"""{MINED}
SELECT itemset_name, utility::DOUBLE AS utility, size, transactions FROM found""",
        "result_roundtrip": f"{MINED} {FLAT}",
    }
