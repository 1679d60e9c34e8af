"""Products, categories and tags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartlane.functions.draws import draw_decimal, draw_int
from cartlane.functions.times import as_of_column
from cartlane.modes import REFERENCE, STRICT, check_mode
from cartlane.operators.slugs import unique_slugs
from cartlane.operators.upserts import insert_new
from cartlane.plans.assign import assign
from cartlane.plans.keys import with_surrogate_key
from cartlane.plans.scratch import written
from cartlane.plans.trees import subtree_totals, tree_intervals

# Names of parent categories, tags per product, ranges of product values.
PARENT_PREFIX = "Product"
TAG_CAP = 5
PRICE_RANGE, TAX_RANGE, STOCK_RANGE = ("10", "1000"), ("0", "20"), (1, 100)


def parent_candidates(categories: DataFrame, prefix: str = PARENT_PREFIX) -> DataFrame:
    """Categories whose name starts with the prefix, in any letter case."""
    return categories.filter(F.col("category_name").ilike(f"{prefix}%"))


def new_categories(
    names: DataFrame, order: str, existing: DataFrame, seed: str, prefix: str = PARENT_PREFIX
) -> DataFrame:
    """``category_name`` rows with a unique slug and a drawn parent, or none."""
    slugged = unique_slugs(names, "category_name", order, existing)
    parents = parent_candidates(existing, prefix)
    return assign(slugged, [order], parents, ["id"], {"id": "category_id"}, f"{seed}-parent", null_slot=True)


def given_categories(
    rows: DataFrame, order: str, existing: DataFrame, as_of, existing_rows: DataFrame | None = None, start=None
) -> DataFrame:
    """Categories as stored: ``category_name`` under the given ``category_id``, or at the top without one.

    A row whose parent is not there is left out, as a reference has to hold. Slugs and keys are given to
    the others in ``order``, so a row that is left out takes none.
    """
    parents = existing.select(F.col("id").alias("category_id")).distinct()
    under = rows.join(parents, "category_id", "left_semi").unionByName(rows.filter("category_id IS NULL"))
    slugged = unique_slugs(under.select(order, "category_name", "category_id"), "category_name", order, existing)
    stored = slugged.withColumn("created_at", as_of_column(as_of))
    return with_surrogate_key(stored, [order], "id", existing if existing_rows is None else existing_rows, start).drop(order)


def with_parent_name(categories: DataFrame) -> DataFrame:
    """Adds the name of the category one level up."""
    parents = categories.select(F.col("id").alias("category_id"), F.col("category_name").alias("parent_name"))
    return categories.join(parents, "category_id", "left")


def category_levels(categories: DataFrame) -> DataFrame:
    """``id, root_id, depth`` for each category.

    Every round doubles the distance that all rows look up, so a tree of depth d takes
    log2(d) joins. Rows that reached their root leave the left side. Raises on a cycle.
    """
    up = F.coalesce("category_id", "id")
    steps = F.when(F.col("category_id").isNull(), F.lit(0)).otherwise(F.lit(1))
    state = categories.select("id", up.alias("up"), steps.alias("steps"), F.col("category_id").isNull().alias("at_root"))
    state = written(state, "levels")
    settled = [state.filter("at_root")]
    open_rows = state.filter("NOT at_root").count()
    rows = state.count()
    while open_rows:
        ahead = state.select(
            F.col("id").alias("up"),
            F.col("up").alias("up2"),
            F.col("steps").alias("steps2"),
            F.col("at_root").alias("at_root2"),
        )
        moved = (
            state.filter("NOT at_root")
            .join(ahead, "up", "left")
            .select(
                "id",
                F.coalesce("up2", "up").alias("up"),
                (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"),
                F.coalesce("at_root2", F.lit(True)).alias("at_root"),
            )
        )
        # Only open rows are written again; those at their root stay where they are.
        moved = written(moved, "levels")
        settled.append(moved.filter("at_root"))
        state = reduce(DataFrame.unionByName, settled).unionByName(moved.filter("NOT at_root"))
        left = moved.filter("NOT at_root")
        # A row that looks at itself, or as far as there are rows, goes round in a circle.
        if not left.filter((F.col("up") == F.col("id")) | (F.col("steps") > F.lit(rows))).isEmpty():
            raise ValueError("the categories form a cycle")
        open_rows = left.count()
    return state.select("id", F.col("up").alias("root_id"), F.col("steps").alias("depth"))


def category_rollup(categories: DataFrame, facts: DataFrame, values: list[str]) -> DataFrame:
    """``id, depth`` and the sums of ``values`` over all facts of each category and those below it.

    ``facts`` name a ``category_id``. Categories on a cycle come with null sums.
    """
    return subtree_totals(tree_intervals(categories), facts, "category_id", values)


def draw_product_values(
    products: DataFrame, keys: list[str], categories: DataFrame, brands: DataFrame, seed: str
) -> DataFrame:
    """Adds a drawn category, brand, price, tax and stock to new products."""
    linked = assign(products, keys, categories, ["id"], {"id": "category_id"}, f"{seed}-category")
    linked = assign(linked, keys, brands, ["id"], {"id": "brand_id"}, f"{seed}-brand")
    return linked.withColumns(
        {
            "product_price": draw_decimal(f"{seed}-price", *PRICE_RANGE, 2, *keys).cast("decimal(15,2)"),
            "product_tax": draw_decimal(f"{seed}-tax", *TAX_RANGE, 2, *keys).cast("decimal(4,2)"),
            "product_quantity": draw_int(f"{seed}-stock", *STOCK_RANGE, *keys).cast("int"),
        }
    )


def stored_tags(
    pairs: DataFrame, order: str, as_of, existing_rows: DataFrame | None = None, start=None
) -> DataFrame:
    """Pairs to insert as rows of the product_tag table."""
    rows = pairs.select(order, "product_id", "tag_id", as_of_column(as_of).alias("created_at"))
    return with_surrogate_key(rows, [order], "id", existing_rows, start).drop(order)


def draw_tags(requests: DataFrame, request_key: str, products: DataFrame, tags: DataFrame, seed: str) -> DataFrame:
    """A drawn product and tag for each request: candidates for ``associate_tags``."""
    with_product = assign(requests, [request_key], products, ["id"], {"id": "product_id"}, f"{seed}-product")
    pairs = assign(with_product, [request_key], tags, ["id"], {"id": "tag_id"}, f"{seed}-tag")
    return pairs.filter("product_id IS NOT NULL AND tag_id IS NOT NULL")


def tags_per_product(product_tag: DataFrame) -> DataFrame:
    return product_tag.groupBy("product_id").agg(F.count(F.lit(1)).alias("tag_count"))


def associate_tags(
    candidates: DataFrame,
    order: str,
    existing: DataFrame,
    cap: int = TAG_CAP,
    mode: str = REFERENCE,
    batch: str | None = None,
) -> DataFrame:
    """The candidate (product, tag) pairs to insert.

    Reference mode turns candidates away when the product already had ``cap`` tags before
    the batch. Strict mode also counts the batch, in ``order``.

    ``batch`` is a column with the number of each candidate's batch, for any number of batches at
    once: each finds the tags there that the ones before it left. All new pairs of a batch go in
    while there is room, so a product takes pairs up to the batch of the one that takes its last place.
    """
    sequence = [order] if batch is None else [batch, order]
    fresh = insert_new(candidates, existing, ["product_id", "tag_id"], sequence)
    had = F.coalesce("tag_count", F.lit(0))
    concerned = existing.join(candidates.select("product_id").distinct(), "product_id", "left_semi")
    counts = tags_per_product(concerned)
    if check_mode(mode) == REFERENCE and batch is None:
        return fresh.join(counts, "product_id", "left").filter(had < cap).select(*candidates.columns)
    # The plain cap first: it is applied before the shuffle, so no product sends more.
    place = F.row_number().over(W.partitionBy("product_id").orderBy(*sequence))
    placed = fresh.withColumn("__place", place).filter(F.col("__place") <= cap).join(counts, "product_id", "left")
    if mode == STRICT:
        return placed.filter(F.col("__place") <= cap - had).select(*candidates.columns)
    full = placed.filter(F.col("__place") == cap - had).select("product_id", F.col(batch).alias("__last"))
    limited = fresh.join(counts, "product_id", "left").filter(had < cap).join(full, "product_id", "left")
    return limited.filter(F.col("__last").isNull() | (F.col(batch) <= F.col("__last"))).select(*candidates.columns)
