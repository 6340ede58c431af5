"""N-gram Jaccard self-join by a MinHash LSH forest.

1. Rows of one text (equal MD5) are one class of copies; all that follows works on different texts.
2. Each text has a label of DEPTH MinHash values in each of TREES prefix tries. Texts that share no
   prefix of the shortest length in use with another text leave the forest; that length is the one at
   which a pair at the threshold meets in some trie with probability RECALL.
3. The matched prefixes start at DEPTH values and are shortened step by step. A step looks at the trie nodes in
   which texts of different longer prefixes meet, and only at pairs that shared no longer prefix in any trie.
   Nodes are cut into blocks of about BLOCK texts; every pair of blocks is one unit of work,
   so no task gets a whole hot node. A pair is looked at in the first trie in which its texts meet.
4. The exact Jaccard similarity of the shingle sets decides. Units give per text the number of its links and the
   least text it is connected with, so no list of pairs is ever written.
5. After each step the links found, each weighted by the inverse of the probability that it was found by now, estimate
   all there are. The descent ends once the recall by that estimate reaches RECALL, or at the shortest length.
6. Connected components over the links give the classes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import Words, cut, map_text, mix64
from noticeflow.llm.components import components

WIDTH, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 16, 8, 0.999
BLOCK = 512
# Bins of similarity, from the threshold to 1.
BINS = 20


def forest_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair of that similarity meets in some tree with probability ``recall``."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def prefix_lengths(floor: int, depth: int = DEPTH) -> list[int]:
    """The lengths of the descent: the way to the shortest one is halved at each step."""
    lengths = [depth]
    while lengths[-1] > floor:
        lengths.append(floor + (lengths[-1] - floor) // 2)
    return lengths


def met(similarity: np.ndarray, length: int, trees: int) -> np.ndarray:
    """The probability that a pair of that similarity shares a prefix of that length in some trie."""
    return 1 - (1 - similarity**length) ** trees


def labels(words: Words, width: int, trees: int) -> list[bytes | None]:
    """For each text its label in every trie: DEPTH values of 16 bits, one for each MinHash function; None without words."""
    row, hashes = words.shingles(width)
    out: list[bytes | None] = [None] * words.texts
    if not len(row):
        return out
    starts = np.flatnonzero(np.diff(np.concatenate([[-1], row])))
    made = np.empty((trees * DEPTH, len(starts)), np.uint16)
    for function in range(trees * DEPTH):
        seed = mix64(np.uint64([2 * function + 1, 2 * function + 2]))
        values = hashes * (seed[0] | np.uint64(1)) + seed[1]
        made[function] = (mix64(np.minimum.reduceat(values ^ (values >> np.uint64(29)), starts)) >> np.uint64(48)).astype(np.uint16)
    by_text = np.ascontiguousarray(made.T)
    for place, text in enumerate(row[starts]):
        out[text] = by_text[place].tobytes()
    return out


def text_key(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def distinct_texts(docs: DataFrame, text: str, key: str, width: int, trees: int) -> DataFrame:
    """_key, least id, number of copies and the label of each different text."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(text_key(text).alias("_key"), F.col(key).alias("_id"), F.col(text).alias("_text"))

    def make(batch: pa.RecordBatch) -> dict:
        found = labels(Words(batch.column("_text")), width, trees)
        return {"_key": batch.column("_key"), "_id": batch.column("_id"), "_label": found}

    marked = map_text(rows, "_text", f"_key binary, _id {kind}, _label binary", make)
    return marked.groupBy("_key").agg(F.min("_id").alias("_id"), F.count("*").alias("_copies"),
                                      F.first("_label").alias("_label"))


def in_tries(texts: DataFrame, trees: int, length: int, longer: int | None, *columns: str) -> DataFrame:
    """Each text once per trie, with the node of its prefix and of its longer prefix (``_child``)."""
    def node(tree: int, size: int):
        return F.xxhash64(F.lit(tree), F.substring("_label", 1 + 2 * DEPTH * tree, 2 * size))

    nodes = F.array(*[F.struct(node(t, length).alias("node"), node(t, longer or length).alias("child")) for t in range(trees)])
    return texts.where("_label IS NOT NULL").select(*columns, F.posexplode(nodes).alias("_tree", "_at")).select(
        *columns, "_tree", F.col("_at.node").alias("_node"), F.col("_at.child").alias("_child"))


def shared_nodes(placed: DataFrame, longer: int | None) -> DataFrame:
    """Nodes of two texts or more; after the first step only those in which different longer prefixes meet."""
    nodes = placed.groupBy("_node").agg(F.count("*").alias("_size"), F.min("_child").alias("_low"), F.max("_child").alias("_high"))
    return nodes.where("_size > 1" if longer is None else "_low < _high").select("_node", "_size")


def units(texts: DataFrame, trees: int, length: int, longer: int | None, block: int) -> DataFrame:
    """(_node, _i, _j, _own, _tree, _key, _copies, _label): every text of a shared node in each of its block pairs."""
    placed = in_tries(texts, trees, length, longer, "_key", "_copies", "_label")
    count = F.ceil(F.col("_size") / block).cast("int")
    each = placed.drop("_child").join(shared_nodes(in_tries(texts, trees, length, longer), longer), "_node").select(
        "*", count.alias("_count")).withColumn("_own", F.pmod(F.xxhash64("_key"), F.col("_count")).cast("int"))
    other = each.select("*", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)).alias("_other"))
    return other.select("_node", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"),
                        "_own", "_tree", "_key", "_copies", "_label")


UNIT = ["_node", "_i", "_j"]


def by_unit(rows: DataFrame) -> DataFrame:
    """All rows of a unit in a row, in one partition."""
    return rows.repartition(*UNIT).sortWithinPartitions(*UNIT, "_key")


def unit_batches(batches):
    """Lists of row dictionaries, one list per unit. A unit holds two blocks at most."""
    unit, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            name = (row["_node"], row["_i"], row["_j"])
            if name != unit:
                if rows:
                    yield rows
                unit, rows = name, []
            rows.append(row)
    if rows:
        yield rows


def new_pairs(rows: list[dict], length: int, longer: int | None) -> np.ndarray:
    """Boolean matrix: the pairs of a unit that belong to its two blocks and have met neither by a longer prefix nor in an earlier trie."""
    tree, blocks = rows[0]["_tree"], np.array([r["_own"] for r in rows])
    wanted = ~np.eye(len(rows), dtype=bool)
    if rows[0]["_i"] != rows[0]["_j"]:
        wanted &= blocks[:, None] != blocks[None, :]
    label = np.frombuffer(b"".join(r["_label"] for r in rows), np.uint16).reshape(len(rows), -1, DEPTH).astype(np.uint64)
    prefix = np.zeros(label.shape[:2], np.uint64)
    for level in range(longer or length):
        if level == length:  # nodes of the earlier tries
            for t in range(tree):
                wanted &= prefix[:, None, t] != prefix[None, :, t]
        prefix = mix64(prefix ^ (label[:, :, level] + np.uint64(1)))
    for t in range(label.shape[1] if longer else tree):
        wanted &= prefix[:, None, t] != prefix[None, :, t]
    return wanted


def common_counts(sets: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """Number of common elements of each pair of sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    renumber = np.full(len(times), -1)
    renumber[shared] = np.arange(len(shared))
    column = renumber[place]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, len(shared), chunk):
        a, z = np.searchsorted(column, [low, low + chunk])
        part = np.zeros((len(sets), min(chunk, len(shared) - low)), np.float32)
        part[owner[a:z], column[a:z] - low] = 1
        counts += part @ part.T
    return np.rint(counts).astype(np.int64)


def verify(rows: list[dict], wanted: np.ndarray, threshold: float) -> tuple[list[tuple], np.ndarray]:
    """(key, least linked key, number of linked rows) of each text of a unit that has links, and its links by similarity in BINS."""
    sets = [np.frombuffer(r["_set"], np.uint64) for r in rows]
    size = np.array([len(s) for s in sets], np.int64)
    both = common_counts(sets)
    union = size[:, None] + size[None, :] - both
    linked = wanted & (both >= threshold * union - 1e-9)
    share = (both[linked] / union[linked] - threshold) / (1 - threshold) if threshold < 1 else np.ones(linked.sum())
    bins = np.bincount(np.clip((share * BINS).astype(np.int64), 0, BINS - 1), minlength=BINS) // 2
    copies = np.array([r["_copies"] for r in rows], np.int64)
    links = linked @ copies
    root = np.arange(len(rows))  # rows stand in order of key
    while True:
        least = np.where(linked, root[None, :], len(rows)).min(axis=1, initial=len(rows))
        nearer = np.minimum(root, least)
        nearer = np.minimum(nearer, nearer[nearer])
        if (nearer == root).all():
            break
        root = nearer
    return [(rows[n]["_key"], rows[root[n]]["_key"], int(links[n])) for n in np.flatnonzero(linked.any(axis=1))], bins


def shingle_sets(docs: DataFrame, texts: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """(_key, _set) of the given texts, the set as its sorted 64-bit hashes."""
    # Only one copy of a text is fetched; the join key holds its id, so copies do not meet in one task.
    wanted = texts.select("_key", F.xxhash64("_id").alias("_who"))
    source = docs.select(text_key(text).alias("_key"), F.xxhash64(F.col(key)).alias("_who"), F.col(text).alias("_text"))
    fetched = source.join(wanted, ["_key", "_who"])

    def make(batch: pa.RecordBatch) -> dict:
        words = Words(batch.column("_text"))
        row, hashes = words.shingles(width)
        bounds = np.searchsorted(row, np.arange(words.texts + 1))
        return {"_key": batch.column("_key"),
                "_set": [np.unique(hashes[a:z]).tobytes() for a, z in zip(bounds[:-1], bounds[1:], strict=True)]}

    # Repeated rows (same id, same text) give equal sets.
    return map_text(fetched, "_text", "_key binary, _set binary", make).dropDuplicates(["_key"])


def step(texts: DataFrame, sets: DataFrame, trees: int, length: int, longer: int | None, threshold: float, block: int) -> DataFrame:
    """(_key, _least, _links) of the pairs that meet first at this prefix length, and rows of their similarities (_bins) without a key."""
    work = units(texts, trees, length, longer, block)
    schema = work.schema

    def meeting(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for rows in unit_batches(batches):
            used = new_pairs(rows, length, longer).any(axis=1)
            if used.any():
                some = [r for r, u in zip(rows, used, strict=True) if u]
                yield pa.RecordBatch.from_pylist(some, schema=arrow)

    def verified(batches):
        for rows in unit_batches(batches):
            found, bins = verify(rows, new_pairs(rows, length, longer), threshold)
            if found:
                keys, roots, links = (list(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*keys, None], pa.binary()), pa.array([*roots, None], pa.binary()), pa.array([*links, None], pa.int64()),
                     pa.array([*[None] * len(keys), bins.tolist()], pa.list_(pa.int64()))], names=["_key", "_least", "_links", "_bins"])

    parts = cut(by_unit(work).mapInArrow(meeting, schema))
    return cut(by_unit(parts.join(sets, "_key")).mapInArrow(verified, "_key binary, _least binary, _links bigint, _bins array<bigint>"))


def estimated_recall(counts: np.ndarray, length: int, trees: int, threshold: float) -> float:
    """Links found by similarity against those there should be, as a pair of the lower edge of its bin is found with ``met``."""
    edges = threshold + (1 - threshold) * np.arange(BINS) / BINS
    total = (counts / met(edges, length, trees)).sum()
    return float(counts.sum() / total) if total else 0.0


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, threshold: float = THRESHOLD,
            trees: int = TREES, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(_key, _id, _copies, _root, _links) of each different text.

    _key: its MD5; _id: least id among its copies; _root: the least _key it is
    connected with; _links: rows of other texts with similarity >= threshold.
    """
    floor = forest_depth(threshold, trees, DEPTH, recall)
    texts = cut(distinct_texts(docs, text, key, width, trees))
    placed = in_tries(texts, trees, floor, None, "_key")
    near = placed.join(shared_nodes(placed, None), "_node", "left_semi").select("_key").distinct()
    forest = cut(texts.join(near, "_key", "left_semi"))
    sets = cut(shingle_sets(docs, forest, text, key, width))
    steps, counts, longer = [], np.zeros(BINS), None
    for length in prefix_lengths(floor):
        made = step(forest, sets, trees, length, longer, threshold, block)
        steps.append(made.where("_key IS NOT NULL").drop("_bins"))
        for place, links in made.where("_bins IS NOT NULL").select(F.posexplode("_bins").alias("b", "n")).groupBy("b").agg(F.sum("n")).collect():
            counts[place] += links  # BINS rows
        if estimated_recall(counts, length, trees, threshold) >= recall:
            break
        longer = length
    found = reduce(DataFrame.unionAll, steps)
    roots = components(found.select(F.col("_key").alias("a"), F.col("_least").alias("b")))
    sums = found.groupBy("_key").agg(F.sum("_links").alias("_links"))
    linked = sums.join(roots.withColumnsRenamed({"node": "_key", "root": "_root"}), "_key", "left")
    return (texts.drop("_label").join(linked, "_key", "left")
            .select("_key", "_id", "_copies", F.coalesce("_root", "_key").alias("_root"),
                    F.coalesce("_links", F.lit(0)).alias("_links")))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """key, class_id, n_copies and n_links of every row. Options: width, threshold, trees, recall, block.

    class_id is the least id among the rows connected by links (similarity of
    the sets of five-word shingles at least 0.8, or equal texts); n_copies the rows of the same text, itself
    included; n_links the other rows it is linked with, copies included.
    A text of fewer words than a shingle is one shingle. Texts without words link
    only with their copies; NULL counts as empty. Rows with a NULL id take part; class_id is NULL only if
    no row of the class has an id. Repeated rows are copies. An empty table gives no rows.
    """
    found = classes(docs, text, key, **options)
    found = cut(found)
    ids = found.groupBy("_root").agg(F.min("_id").alias("class_id"))
    table = found.join(ids, "_root").select("_key", "class_id", F.col("_copies").alias("n_copies"),
                                            (F.col("_links") + F.col("_copies") - 1).alias("n_links"))
    rows = docs.select(F.col(key).alias("_own"), text_key(text).alias("_key"))
    return rows.join(table, "_key", "left").select(F.col("_own").alias(key), "class_id", "n_copies", "n_links")


def one_per_class(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row of each class, with all its columns: the one with the least id (then the least MD5).

    NULL and empty texts are copies of each other, so one row of them stays; rows that repeat id and text leave one. Very
    long texts are compared whole. Columns may have any names; an empty table gives no rows.
    """
    found = cut(classes(docs, text, key, **options))
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_key").alias("key"))
    best = found.groupBy("_root").agg(F.min(order).alias("best")).select(
        F.col("best.key").alias("_key"), F.xxhash64("best.id").alias("_who"))
    rows = docs.select(F.struct("*").alias("_row"), text_key(text).alias("_key"), F.xxhash64(F.col(key)).alias("_who"))
    # Rows that repeat id and text: all but one go before the shuffle.
    once = rows.dropDuplicates(["_key", "_who"])
    return once.join(best, ["_key", "_who"], "left_semi").select("_row.*")
