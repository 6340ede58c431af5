"""Benchmark passages in texts, by pigeonhole edit matching.

A passage of m characters may occur with up to k = int(ERROR_RATE * m) edits. It is
cut into k + 1 pieces; at least one of them then stands in the text unchanged.
An Aho-Corasick automaton finds all pieces in one pass over the text; a hit
names the window where the passage would be, and Myers' bit-parallel distance
decides. Between the two, the same argument on pieces of GRAM characters drops windows
that cannot hold it: an edit spoils one such piece at most.

Texts and passages are compared in lower case, with each run of white space as one space.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import keep_rows, map_text, worker_cache

ERROR_RATE = 0.1
GRAM = 4
# Passages are taken in blocks of about this many characters: the bound of what is broadcast.
BLOCK_CHARS = 1_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(passage: str, errors: int) -> list[tuple[int, int]]:
    """Bounds of errors + 1 pieces of nearly equal length that make up the passage."""
    n = min(errors + 1, len(passage))
    return [(len(passage) * j // n, len(passage) * (j + 1) // n) for j in range(n)]


class Passage:
    def __init__(self, item, text: str, rate: float):
        self.item, self.text = item, text
        self.errors = int(rate * len(text))
        self.masks = self._masks(text)
        self.back_masks = self._masks(text[::-1])
        self.grams = [text[i:i + GRAM] for i in range(0, len(text) - GRAM + 1, GRAM)]

    @staticmethod
    def _masks(text: str) -> dict[str, int]:
        masks: dict[str, int] = {}
        for i, c in enumerate(text):
            masks[c] = masks.get(c, 0) | 1 << i
        return masks

    def find(self, window: str) -> tuple[int, int, int] | None:
        """(distance, start, end) of the best occurrence within the error budget, the first among equals."""
        at = window.find(self.text)
        if at >= 0:
            return 0, at, at + len(self.text)
        spoilt = 0
        for gram in self.grams:
            if gram not in window:
                spoilt += 1
                if spoilt > self.errors:
                    return None
        distance, end = search(self.masks, len(self.text), window)
        if distance > self.errors:
            return None
        _, length = search(self.back_masks, len(self.text), window[:end][::-1])
        return distance, end - length, end


def search(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of the text, and where the first such substring ends.

    Myers (1999): the vertical differences of a column of the distance matrix are kept
    as two bit vectors, here two integers of m bits.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = (down | ~(horizontal | up)) & full
        minus = up & horizontal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus = (plus << 1) & full
        minus = (minus << 1) & full
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    def __init__(self, items: list[tuple], rate: float):
        import ahocorasick

        self.passages = [Passage(item, text, rate) for item, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, passage in enumerate(self.passages):
            for a, z in pieces(passage.text, passage.errors):
                places.setdefault(passage.text[a:z], []).append((number, z))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        self.automaton.make_automaton()

    def hits(self, text: str) -> Iterator[tuple[Passage, int, int, int]]:
        """(passage, distance, start, end) of the occurrences in a normalised text.

        Hits of one occurrence start within ``errors`` of each other; a window spans the starts of one such stretch.
        """
        tried, found = set(), set()
        for last, where in self.automaton.iter(text):
            for number, z in where:
                passage = self.passages[number]
                wide = passage.errors + 1
                stretch = (last + 1 - z) // wide
                if (number, stretch) in tried:
                    continue
                tried.add((number, stretch))
                begin = max(0, stretch * wide - passage.errors)
                window = text[begin:(stretch + 1) * wide + len(passage.text) + passage.errors]
                hit = passage.find(window)
                if hit and (number, begin + hit[2]) not in found:
                    found.add((number, begin + hit[2]))
                    yield passage, hit[0], begin + hit[1], begin + hit[2]


def passage_items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(_passage, _item, _text) of every row of the benchmark; ``_passage`` is the same for texts that are the same normalised.

    NULL and blank passages cannot occur and are left out.
    """
    lowered = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return (benchmark.where(F.length(F.trim(text)) > 0)
            .select(F.md5(lowered.cast("binary")).alias("_passage"), F.col(item).alias("_item"), F.col(text).alias("_text")))


def blocks(items: DataFrame, rate: float) -> Iterator:
    """Broadcast values, each with the passages of one block of BLOCK_CHARS; a passage stands for all its items."""
    passages = items.groupBy("_passage").agg(F.min("_text").alias("text"))
    chars = passages.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = math.ceil(chars / BLOCK_CHARS)
    for number in range(count):
        part = passages.where(F.pmod(F.xxhash64("_passage"), F.lit(count)) == number)
        rows = [(r["_passage"], normal(r["text"])) for r in part.toLocalIterator()]
        rows = sorted((r for r in rows if r[1]), key=lambda r: r[1])
        if rows:
            yield items.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows, rate))


def matcher(shared) -> Matcher:
    name, rows, rate = shared.value
    cache = worker_cache("matchers")
    if name not in cache:
        cache.clear()
        cache[name] = Matcher(rows, rate)
    return cache[name]


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Whole words of the text that a span of its normalised form touches."""
    at, place, begin, stop = 0, 0, 0, 0
    for word in text.split():
        place = text.index(word, place)
        long = len(word.lower())
        if at <= start:
            begin = place
        if at < end:
            stop = place + len(word)
        else:
            break
        at, place = at + long + 1, place + len(word)
    return begin, stop


def find_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id",
                  item: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """(key, item, distance, start, end): each occurrence of a passage in a text.

    start and end are code points of the text as given, widened to whole words.
    Texts without an occurrence give no row; NULL texts are empty; repeated rows
    give their rows again. An empty benchmark or table gives no rows. Each block
    of passages scans the texts once. Items whose passages are the same normalised all have their rows: what is
    found is joined with the items of its passage.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, _passage string, distance int, start bigint, `end` bigint"
    rows = docs.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text")
    items, parts = passage_items(benchmark, item, item_text), []
    for shared in blocks(items, rate):
        def make(batch: pa.RecordBatch, shared=shared) -> dict:
            finder, out, keys = matcher(shared), [], batch.column("_key").to_pylist()
            for number, raw in enumerate(batch.column("_text").to_pylist()):
                for passage, distance, start, end in finder.hits(normal(raw or "")):
                    out.append((keys[number], passage.item, distance, *original_span(raw, start, end)))
            return dict(zip(("_key", "_passage", "distance", "start", "end"),
                            zip(*out, strict=True) if out else [[]] * 5, strict=True))

        parts.append(map_text(rows, "_text", schema, make))
    if not parts:
        found = docs.sparkSession.createDataFrame([], schema)
    else:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionAll(part)
    members = items.select("_passage", "_item").distinct()
    return found.join(members, "_passage").select(
        F.col("_key").alias(key), F.col("_item").alias(item), "distance", "start", "end")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                   item_text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """The rows whose text holds no passage, all columns as they are.

    NULL and empty texts hold none and stay, as do repeated rows and columns of any name; an empty benchmark keeps all rows. Texts
    are searched whole. No shuffle.
    """
    for shared in blocks(passage_items(benchmark, item, item_text), rate):
        def clean(column: pa.Array, shared=shared) -> list:
            finder = matcher(shared)
            return [next(finder.hits(normal(raw or "")), None) is None for raw in column.to_pylist()]

        docs = keep_rows(docs, text, clean)
    return docs
