"""Every operator as a query over the TPC-H-like tables.

A receipt is an order, its lines the order's line items. Items are brands (dense: sets of several
items), suppliers or parts (sparse). Utilities are whole cents, so results are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.itemsets import item_utility, itemset_name, size_class
from ..functions.units import total
from ..operators import baskets, results, twu, utility_list
from ..operators.mining import ENDPOINTS, EXACT, Mining, Mode, mine, mine_top
from ..operators.ordering import by_receipt, dense_index
from ..operators.search_size import search_size as size_of_search
from ..sinks import documents, tables, text as text_sink
from ..sources import text
from ..sources.generate import generate_transactions
from ..sources.tables import items_from
from ..streaming.twu import TwuStore, accumulate_twu
from .run import Run, run
from .workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

# Places on a receipt: line numbers repeat within an order, so the part decides between equals.
LINE_STEP = 10**12
# A threshold of total / SHARE, and the fixed cost per line that makes some utilities negative.
SHARE = 500
SUPPLIER_SHARE = 1000
LONG_SHARE = 30_000
TOP = 50
LINE_COST = 4_000_000
ENTRY_BUDGET_SHARE = 2
BOUND_SHARE = 2
NAMES = ["Brand#1", "Brand#2", "Brand#3"]
SEARCH = "bRAND#2,"
BATCH_DATE = "1999-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def place():
    return F.col("l_linenumber").cast("bigint") * LINE_STEP + F.col("l_partkey")


def lines_with_part(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return table(spark, folder, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))


def brand_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with brands as items and the price as utility."""
    return items_from(
        lines_with_part(spark, folder),
        tid="l_orderkey",
        item="p_brand",
        utility=cents("l_extendedprice"),
        quantity=F.col("l_quantity").cast("bigint"),
        profit=F.col("p_retailprice").cast("decimal(18,4)"),
        pos=place(),
    )


def items_of_orders(spark: SparkSession, folder: str, orders: DataFrame, how: str = "inner") -> DataFrame:
    """Brand items with what ``orders`` (tid, …) says of their receipts; the rows of a receipt are together."""
    # Hashed, as sorting both sides would take several pages of memory more in the same stage.
    return by_receipt(brand_items(spark, folder)).join(orders.hint("shuffle_hash"), "tid", how)


def sold_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with brands as items and quantity x retail price as utility."""
    items = items_from(
        lines_with_part(spark, folder),
        tid="l_orderkey",
        item="p_brand",
        quantity=F.col("l_quantity").cast("bigint"),
        profit=F.col("p_retailprice").cast("decimal(18,4)"),
        pos=place(),
    )
    return items.withColumn("utility", F.col("utility").cast("decimal(28,4)")).dropna(subset=["tid"])


def sold_items(spark: SparkSession, folder: str) -> DataFrame:
    """``sold_lines`` with receipt totals; the rows of a receipt are together."""
    items = by_receipt(sold_lines(spark, folder))
    totals = items.groupBy("tid").agg(F.sum("utility").cast("decimal(28,4)").alias("total_utility"))
    return items.join(totals, "tid")


def keyed_items(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Line items with a key of lineitem as item."""
    lines = table(spark, folder, "lineitem")
    return items_from(
        lines, tid="l_orderkey", item=key, utility=cents("l_extendedprice"), pos=place()
    )


def share_of_total(items: DataFrame, share: int) -> int:
    return items.agg(F.sum(F.greatest("utility", F.lit(0)))).first()[0] // share


def mined(items: DataFrame, mode: Mode = EXACT, share: int = SHARE) -> Mining:
    return mine(items, share_of_total(items, share), mode)


def mined_brands(spark: SparkSession, folder: str, mode: Mode = EXACT) -> DataFrame:
    return whole(mined(brand_items(spark, folder), mode).itemsets, "utility")


def whole(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of cents, which the tables keep within BIGINT, as such."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def flat(itemsets: DataFrame) -> DataFrame:
    return whole(itemsets, "utility").select("itemset_name", "utility", "size", "transactions")


def mean(df: DataFrame, column: str) -> int:
    """The whole mean of a BIGINT column, whose sum may be larger than BIGINT."""
    added, count = df.agg(total(column), F.count(column)).first()
    return int(added) // count


# Sources and sinks


def parse_transactions(spark: SparkSession, folder: str) -> DataFrame:
    lines = text_sink.render_lines(sold_items(spark, folder))
    return as_doubles(text.explode_items(text.parse_lines(lines)))


def as_doubles(items: DataFrame) -> DataFrame:
    amounts = ["profit", "utility", "total_utility"]
    return items.withColumns({c: F.col(c).cast("double") for c in amounts if c in items.columns})


def read_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = Workspace(spark).path("receipts")
    text_sink.write_transactions(sold_items(spark, folder), path)
    lines = as_doubles(text.read_transactions(spark, path))
    return lines.groupBy("pos", "item", "quantity", "profit", "total_utility").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("tid").alias("receipts")
    )


def file_tids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of the receipts of several files: how many, from where to where, and a sum that shows gaps."""
    path = Workspace(spark).path("receipts")
    text_sink.write_transactions(sold_items(spark, folder), path)
    ids = text.read_transactions(spark, path).groupBy("tid").agg(F.count(F.lit(1)).alias("lines"))
    return ids.agg(
        F.min("tid").alias("first"),
        F.max("tid").alias("last"),
        F.count(F.lit(1)).alias("receipts"),
        F.sum("tid").alias("sum_of_ids"),
        F.sum("lines").alias("lines"),
    )


def dense_tid(spark: SparkSession, folder: str) -> DataFrame:
    receipts = table(spark, folder, "lineitem").select("l_orderkey").distinct()
    return dense_index(receipts, "tid", [F.col("l_orderkey")])


def stated_totals(spark: SparkSession, folder: str) -> DataFrame:
    # Open orders state no total, partly filled ones a zero.
    stated = F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("bigint")).when(
        F.col("o_orderstatus") != "O", cents("o_totalprice")
    )
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("tid"), stated.alias("stated"))


def transaction_totals(spark: SparkSession, folder: str) -> DataFrame:
    added = brand_items(spark, folder).groupBy("tid").agg(F.sum("utility").alias("added"))
    return added.join(stated_totals(spark, folder), "tid", "left").select(
        "tid", text.receipt_total("stated", "added").alias("total_utility")
    )


def explode_items(spark: SparkSession, folder: str) -> DataFrame:
    items = as_doubles(brand_items(spark, folder))
    return items.select("tid", "pos", "item", "quantity", "profit", F.col("utility").cast("bigint"))


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = Workspace(spark).path("csv")
    tables.write_csv(tables.csv_layout(mined_brands(spark, folder)), path)
    return tables.read_csv(spark, path)


def result_rows_legacy(spark: SparkSession, folder: str) -> DataFrame:
    items = brand_items(spark, folder)
    limit = share_of_total(items, SHARE)
    return tables.legacy_csv_layout(whole(mine(items, limit).itemsets, "utility"), limit)


def render_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return text_sink.render_lines(sold_items(spark, folder))


def result_json(spark: SparkSession, folder: str) -> DataFrame:
    return documents.json_lines(mined_brands(spark, folder))


def report_lines(spark: SparkSession, folder: str) -> DataFrame:
    return documents.report_entries(mined_brands(spark, folder))


def ranked_export(spark: SparkSession, folder: str) -> DataFrame:
    return tables.ranked_csv_layout(mined_brands(spark, folder))


def result_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = Workspace(spark).path("result")
    tables.write_result(mined_brands(spark, folder), path)
    return flat(tables.read_result(spark, path))


def generated(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey")
    return as_doubles(generate_transactions(orders, tid="o_orderkey"))


# Lines and receipts


def line_utility(spark: SparkSession, folder: str) -> DataFrame:
    lines = lines_with_part(spark, folder)
    utility = item_utility("l_quantity", "p_retailprice")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", utility.alias("utility"))


def item_lookup(spark: SparkSession, folder: str) -> DataFrame:
    found = baskets.item_lookup(brand_items(spark, folder), NAMES[0])
    return found.withColumn("profit", F.col("profit").cast("double"))


def item_utility_or_zero(spark: SparkSession, folder: str) -> DataFrame:
    return baskets.item_utility_or_zero(brand_items(spark, folder), NAMES[0])


def contains_all(spark: SparkSession, folder: str) -> DataFrame:
    return baskets.contains_all(brand_items(spark, folder), NAMES[:2])


def contains_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The orders that hold all brands of three parts in a row, for every such row of parts."""
    places = F.explode(F.sequence(F.col("p_partkey") - 2, F.col("p_partkey")))
    lists = table(spark, folder, "part").select(places.alias("list_id"), F.col("p_brand").alias("item"))
    return baskets.contains_lists(brand_items(spark, folder), lists)


def remaining_after(spark: SparkSession, folder: str) -> DataFrame:
    return baskets.remaining_after(brand_items(spark, folder), NAMES[:2])


# TWU


def twu_query(spark: SparkSession, folder: str) -> DataFrame:
    return whole(twu.twu(brand_items(spark, folder)), "twu")


def twu_stated(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("tid"), cents("o_totalprice").alias("total_utility")
    )
    return whole(twu.twu(items_of_orders(spark, folder, orders), totals="stated"), "twu")


def twu_contributions(spark: SparkSession, folder: str) -> DataFrame:
    return whole(twu.twu_contributions(brand_items(spark, folder)), "twu")


def twu_merge(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("tid"), "o_orderdate")
    items = items_of_orders(spark, folder, orders)
    earlier = F.col("o_orderdate") < BATCH_DATE
    return whole(twu.merge_twu(twu.twu(items.filter(earlier)), twu.twu(items.filter(~earlier))), "twu")


def twu_in_drops(spark: SparkSession, folder: str) -> DataFrame:
    """TWU of receipts that arrive in two drops of files, the second one read after the first has been stored."""
    workspace = Workspace(spark)
    inbox, store = workspace.path("inbox"), TwuStore(spark, workspace.path("twu-store"))
    before = F.col("o_orderdate") < BATCH_DATE
    dates = table(spark, folder, "orders").groupBy(F.col("o_orderkey").alias("tid"))
    dates = dates.agg(F.bool_or(before).alias("earlier"), F.bool_or(~before).alias("later"))
    # The lines of both drops are made once.
    lines = workspace.store(text_sink.render_lines(sold_items(spark, folder)).join(dates, "tid"), "lines")
    checkpoint = workspace.path("seen")
    for drop in ("earlier", "later"):
        text_sink.write_lines(lines.filter(drop), inbox, mode="append")
        accumulate_twu(spark, inbox, store, checkpoint)
    return store.read().select("item", F.col("twu").cast("double").alias("twu"))


def stored_twu(items: DataFrame) -> tuple[DataFrame, int]:
    """The TWU of line items, computed once, and its mean as a threshold."""
    twu_map = whole(Workspace(items.sparkSession).store(twu.twu(items), "twu"), "twu")
    return twu_map, mean(twu_map, "twu")


def promising_items(spark: SparkSession, folder: str) -> DataFrame:
    return twu.promising_items(*stored_twu(keyed_items(spark, folder, "l_partkey")))


def item_rank(spark: SparkSession, folder: str) -> DataFrame:
    return twu.item_rank(*stored_twu(keyed_items(spark, folder, "l_partkey")))


def promising_transactions(spark: SparkSession, folder: str) -> DataFrame:
    items = keyed_items(spark, folder, "l_partkey")
    kept = twu.promising_transactions(items, promising_items(spark, folder))
    return kept.select("tid", "pos", "item", "utility", "total_utility")


def item_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    items = twu.merge_duplicates(keyed_items(spark, folder, "l_partkey"))
    return twu.item_occurrences(items, promising_items(spark, folder))


def estimated_entries(spark: SparkSession, folder: str) -> DataFrame:
    return twu.estimated_entries(item_occurrences(spark, folder))


def suggest_min_util(spark: SparkSession, folder: str) -> DataFrame:
    # One pass over the lines gives both the TWU and the number of receipts of each item.
    sums = Workspace(spark).store(twu.twu_units(keyed_items(spark, folder, "l_partkey")), "sums")
    twu_map = whole(sums.select("item", "twu"), "twu")
    limit = mean(twu_map, "twu")
    counts = sums.select("item", "occurrences").join(twu.promising_items(twu_map, limit).select("item"), "item", "left_semi")
    budget = twu.estimated_entries(counts).first()[0] // ENTRY_BUDGET_SHARE
    return twu.suggest_min_util(twu_map, counts, budget, limit)


# Utility lists


def brand_lists(spark: SparkSession, folder: str, remaining: str) -> DataFrame:
    items = brand_items(spark, folder)
    ranks = twu.item_rank(twu.twu(items), share_of_total(items, SHARE))
    return utility_list.build_utility_list(items, ranks, remaining)


def part_lists(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    items = keyed_items(spark, folder, "l_partkey")
    twu_map, limit = stored_twu(items)
    return utility_list.build_utility_list(items, twu.item_rank(twu_map, limit)), limit


def utility_list_position(spark: SparkSession, folder: str) -> DataFrame:
    entries = utility_list.entry_totals(brand_lists(spark, folder, "position"))
    return entries.select("tid", "item", "iu", "ru", "total")


def utility_list_twu(spark: SparkSession, folder: str) -> DataFrame:
    return part_lists(spark, folder)[0]


def flag_items(spark: SparkSession, folder: str) -> DataFrame:
    """Parts by return flag: three receipts, each with a large share of all lines."""
    lines = table(spark, folder, "lineitem")
    return items_from(lines, tid="l_returnflag", item="l_partkey", utility=cents("l_extendedprice"))


def utility_list_long(spark: SparkSession, folder: str) -> DataFrame:
    items = flag_items(spark, folder)
    twu_map, limit = stored_twu(items)
    return utility_list.build_utility_list(items, twu.item_rank(twu_map, limit), segmented=True)


def list_sums(entries: DataFrame) -> DataFrame:
    return whole(utility_list.itemset_sums(entries), "sum_iu", "sum_ru", "upper_bound")


def item_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return list_sums(brand_lists(spark, folder, "position"))


def extendable_items(spark: SparkSession, folder: str) -> DataFrame:
    entries, limit = part_lists(spark, folder)
    return utility_list.extendable(list_sums(entries), limit // BOUND_SHARE)


def prunable_items(spark: SparkSession, folder: str) -> DataFrame:
    entries, limit = part_lists(spark, folder)
    return utility_list.prunable(list_sums(entries), limit // BOUND_SHARE)


def loss_items(spark: SparkSession, folder: str) -> DataFrame:
    return brand_items(spark, folder).withColumn("utility", F.col("utility") - LINE_COST)


def item_bounds_losses(spark: SparkSession, folder: str) -> DataFrame:
    items = loss_items(spark, folder)
    ranks = twu.item_rank(twu.twu(items), share_of_total(items, SHARE))
    return list_sums(utility_list.build_utility_list(items, ranks))


def prunable_items_losses(spark: SparkSession, folder: str) -> DataFrame:
    sums = Workspace(spark).store(item_bounds_losses(spark, folder), "sums")
    return utility_list.prunable(sums, mean(sums, "upper_bound"))


def empty_prefix_list(spark: SparkSession, folder: str) -> DataFrame:
    lists = brand_lists(spark, folder, "position")
    return utility_list.empty_prefix_list(lists.filter(F.col("item") == NAMES[0]))


def pair_utility_list(spark: SparkSession, folder: str) -> DataFrame:
    """The list of {a, b, c} from those of {a, b} and {a, c}, which share {a}."""
    lists = brand_lists(spark, folder, "position")
    a, b, c = (lists.filter(F.col("item") == name) for name in NAMES)
    nothing = utility_list.empty_prefix_list(a)
    ab = utility_list.join_utility_lists(a, b, nothing)
    ac = utility_list.join_utility_lists(a, c, nothing)
    return utility_list.join_utility_lists(ab, ac, a)


# Mining


def mine_exact(spark: SparkSession, folder: str) -> DataFrame:
    return flat(mined_brands(spark, folder))


def mine_endpoints(spark: SparkSession, folder: str) -> DataFrame:
    return flat(mined_brands(spark, folder, ENDPOINTS))


def mine_exact_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return flat(mined(keyed_items(spark, folder, "l_suppkey"), share=SUPPLIER_SHARE).itemsets)


def mine_endpoints_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    items = keyed_items(spark, folder, "l_suppkey")
    return flat(mined(items, ENDPOINTS, SUPPLIER_SHARE).itemsets)


def mine_exact_losses(spark: SparkSession, folder: str) -> DataFrame:
    return flat(mined(loss_items(spark, folder)).itemsets)


def stated_items(spark: SparkSession, folder: str) -> DataFrame:
    """Brand items of receipts of which some state a total, some a zero and some none."""
    return items_of_orders(spark, folder, stated_totals(spark, folder), "left")


def mine_endpoints_stated(spark: SparkSession, folder: str) -> DataFrame:
    items = stated_items(spark, folder).withColumnRenamed("stated", "total_utility")
    return flat(mined(items, ENDPOINTS).itemsets)


def orders_and_all_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """Orders, and one receipt more that holds every part for a cent; a threshold."""
    items = keyed_items(spark, folder, "l_partkey")
    parts = table(spark, folder, "part")
    everything = items_from(parts, tid=F.lit(-1).cast("bigint"), item="p_partkey", utility=F.lit(1).cast("bigint"), pos=F.col("p_partkey"))
    return items.unionByName(everything), share_of_total(items, LONG_SHARE)


def mine_exact_long(spark: SparkSession, folder: str) -> DataFrame:
    items, limit = orders_and_all_parts(spark, folder)
    return flat(mine(items, limit).itemsets)


def mine_endpoints_long(spark: SparkSession, folder: str) -> DataFrame:
    items, limit = orders_and_all_parts(spark, folder)
    return flat(mine(items, limit, ENDPOINTS).itemsets)


def search_size(spark: SparkSession, folder: str) -> DataFrame:
    items = keyed_items(spark, folder, "l_suppkey")
    return size_of_search(items, share_of_total(items, SUPPLIER_SHARE))


def top_k_mining(spark: SparkSession, folder: str) -> DataFrame:
    return flat(mine_top(brand_items(spark, folder), TOP).itemsets)


def mine_stats(spark: SparkSession, folder: str) -> DataFrame:
    return mined(brand_items(spark, folder)).stats()


def mine_stats_endpoints(spark: SparkSession, folder: str) -> DataFrame:
    return mined(brand_items(spark, folder), ENDPOINTS).stats()


def run_of_text(spark: SparkSession, folder: str, mode: Mode) -> Run:
    """Write the receipts as text and mine the files from end to end."""
    path = Workspace(spark).path("receipts")
    # Added up while the receipts are written.
    seen = Observation()
    text_sink.write_transactions(sold_items(spark, folder).observe(seen, F.sum("utility").alias("sold")), path)
    return run(spark, path, int(seen.get["sold"]) // SHARE, mode)


def run_text(spark: SparkSession, folder: str) -> DataFrame:
    return run_of_text(spark, folder, EXACT).itemsets.drop("itemset")


def run_text_endpoints(spark: SparkSession, folder: str) -> DataFrame:
    return run_of_text(spark, folder, ENDPOINTS).itemsets.drop("itemset")


def run_text_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters and summary of a run from text, side by side."""
    result = run_of_text(spark, folder, EXACT)
    sizes = result.summary.select(F.col("count").alias("itemsets"), "max_size", "single_items", "pairs", "larger", "max_utility")
    both = result.counters.withColumn("_row", F.lit(1)).join(sizes.withColumn("_row", F.lit(1)), "_row")
    return both.drop("_row").withColumn("max_utility", F.col("max_utility").cast("double"))


def result_document(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the JSON document; averages are left out, as engines print doubles in different ways."""
    items = brand_items(spark, folder)
    limit = share_of_total(items, SHARE)
    mining = mine(items, limit)
    lines = documents.result_document(whole(mining.itemsets, "utility"), mining.stats(), limit)
    averages = r'"avg_[a-z]+":[^,}]*,'
    return lines.select("place", F.regexp_replace("json", averages, "").alias("json"))


# Results


def result_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = results.result_rows(mined_brands(spark, folder))
    return rows.withColumn("itemset", F.array_join("itemset", "|"))


def sort_by_size(spark: SparkSession, folder: str) -> DataFrame:
    return flat(results.sort_itemsets(mined_brands(spark, folder), "size"))


def top10(spark: SparkSession, folder: str) -> DataFrame:
    return flat(results.top_itemsets(mined_brands(spark, folder)))


def search_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    return flat(results.search_itemsets(mined_brands(spark, folder), SEARCH))


def bar_percent(spark: SparkSession, folder: str) -> DataFrame:
    rows = results.bar_percent(mined_brands(spark, folder))
    return rows.select("itemset_name", "utility", "percent")


def summary_stats(spark: SparkSession, folder: str) -> DataFrame:
    return whole(results.summary_stats(mined_brands(spark, folder)), "max_utility", "min_utility")


def size_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return results.size_distribution(mined_brands(spark, folder))


def name_of_itemset(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    name = itemset_name(F.array("p_type", "p_name", "p_brand"))
    return part.select("p_partkey", name.alias("itemset_name"))


def class_of_size(spark: SparkSession, folder: str) -> DataFrame:
    sizes = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("size")
    )
    return sizes.select("l_orderkey", "size", size_class("size").alias("size_class"))


def queries() -> dict[str, Query]:
    return {
        "parse_transactions": parse_transactions,
        "read_transactions": read_transactions,
        "file_tids": file_tids,
        "dense_tid": dense_tid,
        "transaction_totals": transaction_totals,
        "explode_items": explode_items,
        "render_transactions": render_transactions,
        "generate_transactions": generated,
        "item_utility": line_utility,
        "item_lookup": item_lookup,
        "item_utility_or_zero": item_utility_or_zero,
        "contains_all": contains_all,
        "contains_lists": contains_lists,
        "remaining_after": remaining_after,
        "twu": twu_query,
        "twu_stated": twu_stated,
        "twu_contributions": twu_contributions,
        "twu_merge": twu_merge,
        "twu_in_drops": twu_in_drops,
        "promising_items": promising_items,
        "item_rank": item_rank,
        "promising_transactions": promising_transactions,
        "item_occurrences": item_occurrences,
        "estimated_entries": estimated_entries,
        "suggest_min_util": suggest_min_util,
        "utility_list_position": utility_list_position,
        "utility_list_twu": utility_list_twu,
        "utility_list_long": utility_list_long,
        "item_bounds": item_bounds,
        "item_bounds_losses": item_bounds_losses,
        "extendable_items": extendable_items,
        "prunable_items": prunable_items,
        "prunable_items_losses": prunable_items_losses,
        "empty_prefix_list": empty_prefix_list,
        "pair_utility_list": pair_utility_list,
        "mine_exact": mine_exact,
        "mine_endpoints": mine_endpoints,
        "mine_exact_suppliers": mine_exact_suppliers,
        "mine_endpoints_suppliers": mine_endpoints_suppliers,
        "mine_exact_losses": mine_exact_losses,
        "mine_endpoints_stated": mine_endpoints_stated,
        "mine_exact_long": mine_exact_long,
        "mine_endpoints_long": mine_endpoints_long,
        "search_size": search_size,
        "top_k_mining": top_k_mining,
        "mine_stats": mine_stats,
        "mine_stats_endpoints": mine_stats_endpoints,
        "run_text": run_text,
        "run_text_endpoints": run_text_endpoints,
        "run_text_counters": run_text_counters,
        "result_rows": result_rows,
        "sort_by_size": sort_by_size,
        "top10": top10,
        "search_itemsets": search_itemsets,
        "bar_percent": bar_percent,
        "summary_stats": summary_stats,
        "size_distribution": size_distribution,
        "itemset_name": name_of_itemset,
        "size_class": class_of_size,
        "result_json": result_json,
        "result_document": result_document,
        "report_lines": report_lines,
        "ranked_export": ranked_export,
        "result_rows_legacy": result_rows_legacy,
        "csv_roundtrip": csv_roundtrip,
        "result_roundtrip": result_roundtrip,
    }
