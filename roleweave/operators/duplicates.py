"""The same job found by several sources: fuzzy matching on company, title and location.

Two postings of different sources match if their companies are the same, their titles differ by at most `edits`
characters, and their places are the same or one of them is not stated; all three as words in lower case. Matches
connect postings to groups, and one posting of each group survives.

Titles are compared only where they share a blocking key, and no match is lost by that: `edits` changes can't touch all of
`edits` + 1 segments of a title, so one segment of the shorter title stands unchanged in the longer one, not more than
`edits` characters from its place. Postings that agree in all three are one node before anything is compared, places are
joined by their value, and a posting without a place is a star, so neither a common title nor a common place becomes all its
pairs. A key that very many titles share is dealt out over salts, the titles that look for it being copied to each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.session import stage

EDITS = 2
# Titles of one blocking key that one task compares.
BLOCK = 1000


def words_of(text: Column) -> Column:
    """Lower-case letters and digits with single blanks between words; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """(start from 0, length) of the segments of a title of this length; the last ones are longer by one."""
    n = edits + 1
    short, rest = F.floor(length / n).cast("int"), (length % n).cast("int")
    out = []
    for i in range(n):
        longer = F.greatest(F.lit(i) - (n - rest), F.lit(0))
        out.append((short * i + longer, short + F.when(F.lit(i) >= n - rest, 1).otherwise(0)))
    return out


def _hashed(company: Column, length: Column, i: int, part: Column) -> Column:
    """Key of a segment. Keys that collide cost a comparison and nothing else."""
    return F.xxhash64(company, length, F.lit(i), part)


def own_keys(company: Column, title: Column, edits: int) -> Column:
    """Keys of the title's own segments."""
    size = F.char_length(title)
    return F.array(*[_hashed(company, size, i, F.substring(title, at + 1, n)) for i, (at, n) in enumerate(_segments(size, edits))])


def asked_keys(company: Column, title: Column, edits: int) -> Column:
    """Keys under which a title as long, or shorter by at most `edits`, may be found."""
    size, keys = F.char_length(title), []
    for less in range(edits + 1):
        length = size - less
        for i, (at, n) in enumerate(_segments(length, edits)):
            for shift in range(-edits, edits + 1):
                begin = at + shift
                inside = (length >= 0) & (begin >= 0) & (begin + n <= size)
                keys.append(F.when(inside, _hashed(company, length, i, F.substring(title, begin + 1, n))))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def similar_titles(titles: DataFrame, edits: int = EDITS, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of the ids of (title_id, company, title) with the same company and at most `edits` edits, once each.

    Titles are distinct within a company. A pair stands in the order of length, then of id.
    """
    size = F.char_length("title").alias("size")
    company, title = F.col("company"), F.col("title")
    index = stage(titles.select(F.col("title_id").alias("a"), size.alias("size_a"), F.explode(own_keys(company, title, edits)).alias("key")), "title_keys")
    asked = titles.select(F.col("title_id").alias("b"), size.alias("size_b"), F.explode(asked_keys(company, title, edits)).alias("key"))
    heavy = index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    heavy = stage(heavy.select("key", F.ceil(F.col("n") / block).cast("int").alias("salts")), "title_blocks")
    salts = F.coalesce("salts", F.lit(1))
    dealt = index.join(heavy, "key", "left").select("a", "size_a", "key", F.pmod(F.xxhash64("a"), salts).cast("int").alias("salt"))
    copied = asked.join(heavy, "key", "left").select("b", "size_b", "key", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    first = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
    pairs = dealt.join(copied, ["key", "salt"]).where(first).select("a", "b").distinct()
    left = titles.select(F.col("title_id").alias("a"), F.col("company").alias("_company"), F.col("title").alias("_title"))
    right = titles.select(F.col("title_id").alias("b"), "company", "title")
    near = F.levenshtein("_title", "title", edits) >= 0
    return pairs.join(left, "a").join(right, "b").where((F.col("_company") == F.col("company")) & near).select("a", "b")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of the edges (a, b) is connected with.

    Labels go along edges and then to the label of the label, so the rounds grow with the logarithm of the longest path.
    Every round is a written table; a node with many edges is reduced before the shuffle.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    while True:
        offered = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_root"))
        least = labels.join(offered, "node").select("node", F.col("root").alias("_old"), F.least("root", "_root").alias("root"))
        jump = least.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        moved = stage(least.join(jump, "root", "left").select("node", "_old", F.coalesce("_next", "root").alias("root")), "labels")
        labels = moved.select("node", "root")
        if moved.where("root <> _old").isEmpty():
            return labels


def cross_source_groups(postings: DataFrame, edits: int = EDITS, block: int = BLOCK) -> DataFrame:
    """id, group_id (the least id of the group) and survives of every posting (id, source, company, title, location).

    Of a group stays a posting of a company's own board before those of an aggregator, then the one of the least id. Postings
    without a company or a title match nothing.
    """
    rows = postings.select(
        "id",
        F.coalesce("source", F.lit("")).alias("source"),
        *[words_of(F.col(c)).alias(c) for c in ("company", "title")],
        words_of(F.col("location")).alias("place"),
    )
    rows = stage(rows, "fuzzy_postings")
    keys = ["company", "title", "place"]
    named = rows.where("company <> '' and title <> ''")
    nodes = named.groupBy(*keys).agg(F.min("id").alias("node"), F.min("source").alias("low"), F.max("source").alias("high"))
    titles = stage(nodes.groupBy("company", "title").agg(F.min("node").alias("title_id")), "fuzzy_titles")
    nodes = stage(nodes.join(titles, ["company", "title"]), "fuzzy_nodes")
    near = similar_titles(titles, edits, block)
    near = stage(near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b"))), "fuzzy_titles_near")
    one = nodes.select(F.col("title_id").alias("a"), "place", F.col("node").alias("x"), F.col("low").alias("low_x"), F.col("high").alias("high_x"))
    two = nodes.select(F.col("title_id").alias("b"), F.col("place").alias("_place"), F.col("node").alias("y"), F.col("low").alias("low_y"), F.col("high").alias("high_y"))
    ends = ["x", "low_x", "high_x", "y", "low_y", "high_y"]
    same_place = near.join(one, "a").join(two, [near["b"] == two["b"], F.col("place") == F.col("_place")]).select(*ends)
    # A title has one node without a place; it matches all nodes of the titles near it and of its own.
    itself = titles.select(F.col("title_id").alias("a"), F.col("title_id").alias("b"))
    stars = near.union(itself).join(one.where("place = ''"), "a").join(two, "b").where("x <> y").select(*ends)
    several = F.least("low_x", "low_y") != F.greatest("high_x", "high_y")
    edges = same_place.union(stars).where(several).select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = connected(edges).withColumnRenamed("node", "_node")
    grouped = nodes.join(roots, F.col("node") == F.col("_node"), "left").select(*keys, "node", "root", (F.col("low") != F.col("high")).alias("several"))
    group = F.when(F.col("root").isNotNull() | F.col("several"), F.coalesce("root", "node")).otherwise(F.col("id"))
    out = stage(rows.join(grouped, keys, "left").select("id", "source", group.alias("group_id")), "fuzzy_groups")
    order = F.struct(F.lower("source").startswith("jobspy").alias("collected"), "id")
    best = out.groupBy("group_id").agg(F.min(order).alias("_best"))
    return out.join(best, "group_id").select("id", "group_id", (F.col("id") == F.col("_best.id")).alias("survives"))
