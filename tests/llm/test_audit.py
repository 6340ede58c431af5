"""Filter audit, piece tokenizer and dataset manifest against brute force."""

import random
import re
from collections import Counter
from hashlib import sha256
from itertools import permutations
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeflow.llm import filter_audit, merkle, pieces
from noticeflow.llm.queries_corpus_audit import FIELDS, piece_model_path, tampered_leaf

from .helpers import AWKWARD, documents, prose

# --- op11 ------------------------------------------------------------------------


def brute_audit(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    judged = []
    for doc, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": any(o is not None and doc is not None and o < doc and (t or "") == text for o, t, _ in docs)}
        good = any(d == doc and q == 1 for d, q, _ in labels if d is not None)
        toxic = any(d == doc and x == 1 for d, _, x in labels if d is not None)
        judged.append((lang or "", fails, good, toxic))
    rows = {}
    for part in {p for p, *_ in judged}:
        own = [j for j in judged if j[0] == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                reached = [j for j in own if not any(j[1][g] for g in order[:k])]
                gone = [j for j in reached if j[1][f]]
                shapley[f] += len(gone)
                rows[part, order, k + 1] = [
                    len(reached) - len(gone), len(gone), sum(j[1][f] for j in own) - len(gone),
                    sum(j[1][f] and sum(j[1].values()) == 1 for j in own), sum(j[2] for j in gone), sum(j[3] for j in gone)]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return rows


def test_audit_against_brute_force(spark):
    pick = random.Random(5)
    texts = AWKWARD + [prose(n, s) for n, s in ((250, 1), (250, 1), (199, 2), (200, 3))]
    texts += [prose(240, 4) + " #", "THE " * 210, prose(230, 6).upper(), "x y " * 150, prose(250, 1)]
    docs = [(t[0] if isinstance(t, tuple) else n, t[1] if isinstance(t, tuple) else t, pick.choice(["en", "de", None, ""]))
            for n, t in enumerate(texts)]
    docs += [(900 + n, prose(220, 9), "hot") for n in range(40)] + [(900, prose(220, 9), "hot"), (950, "", "hot")]
    labels = [(d, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for d, *_ in docs if d is None or d % 2 == 0]
    labels += [(900, 1, 0), (900, 0, 1), (None, 1, 1), (77_777, 1, 1)]
    made = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumn("part", F.lit("clash"))
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    for frame in (made, made.repartition(7)):
        got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                                   r.toxic_lost, r.shapley] for r in filter_audit.audit(frame, marks).collect()}
        assert got == brute_audit(docs, labels)
    assert filter_audit.audit(made.limit(0), marks).count() == 0
    assert filter_audit.audit(made, marks.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_spans_are_verified_not_only_hashed(monkeypatch):
    blobs = [b.encode() for b in ("a b a c", "", " aa aa\tab\n", "é é é", "w " * 50 + "w" * 500 + " " + "w" * 501, "B #b")]
    want = [len(set(re.findall(r"[^\x20\x09-\x0D]+", b.decode()))) for b in blobs]
    assert filter_audit.Measured(blobs).distinct.tolist() == want
    monkeypatch.setattr(filter_audit, "span_hash", lambda raw, start, end: np.zeros(len(start), np.uint64))
    got = filter_audit.Measured(blobs)
    assert got.distinct.tolist() == want
    assert got.points.tolist() == [len(b.decode()) for b in blobs]
    assert got.capitals.tolist() == [0, 0, 0, 0, 0, 1] and got.symbols.tolist() == [0, 0, 0, 0, 0, 1]


def test_only_hashes_and_bits_are_shuffled(spark):
    docs = documents(spark, ["a"])
    plan = filter_audit.failed_counts(filter_audit.measure(docs), spark.createDataFrame(
        [(1, 1, 0)], "doc_id bigint, quality int, toxic int"))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("_text" in line for line in exchanges)


# --- op12 ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def agree(library, texts):
    model = pieces.Model.of(piece_model_path())
    ids, begin = pieces.encode_batch(model, texts)
    want = library.encode(texts, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == want
    assert pieces.decode_batch(model, ids, begin) == [library.decode(w) for w in want]


def test_pieces_of_odd_texts(library):
    agree(library, ["", " ", "  a  b ", "a\tb\n\nc", "▁x", "▁", "é ﬁ Ａ", "\x00a", "<s> </s> <0x0A> <unk>",
                    "﻿z", "\U0001f600 x", "a   ", "​", " ⁇ ", "�", "a\r\nb"])
    agree(library, [])
    agree(library, ["", ""])


def test_pieces_of_random_texts(library):
    pick = random.Random(3)
    names = [library.id_to_piece(i) for i in range(259, 32_000)]
    wide = [chr(c) for c in [*range(32, 0x600), *range(0x3040, 0x3100), *range(0x4E00, 0x5000), 0x1F600]]
    for letters, size, count in ((" .-=_*/\\\n\tab", 60, 4000), ("etaoinshr ", 60, 4000), (names, 12, 4000), (wide, 40, 3000)):
        agree(library, ["".join(pick.choice(letters) for _ in range(pick.randint(0, size))) for _ in range(count)])
    agree(library, [" " * pick.randint(0, 70) + "x" * pick.randint(0, 40) + "=" * pick.randint(0, 70) for _ in range(1500)])


def test_pieces_of_very_long_words(library):
    pick = random.Random(4)
    agree(library, ["x" * 200_000, " " * 200_000, "ab" * 100_000, "".join(pick.choice("abcdefgh") for _ in range(100_000))])


def test_equal_scores_take_the_leftmost_pair():
    """A vocabulary in which longer pieces beat shorter ones and three pieces share a rank."""
    model = pieces.Model.of(piece_model_path())
    small = object.__new__(pieces.Model)
    small.__dict__ = dict(model.__dict__)
    names = {"a": 0, "b": 1, "ab": 2, "ba": 3, "aa": 4, "aba": 5, "abab": 6}
    score = {"ab": 1, "ba": 1, "aa": 1, "aba": 0, "abab": 2}
    order = {s: n for n, s in enumerate(sorted(set(score.values())))}
    pairs = sorted((names[n[:k]] << 32 | names[n[k:]], names[n], order[s]) for n, s in score.items()
                   for k in range(1, len(n)) if n[:k] in names and n[k:] in names)
    small.pair, small.merged, small.rank = (np.array(c, np.int64) for c in zip(*pairs))
    small.tied, small.ties = np.array([False, True, False]), {}

    def one_by_one(word):
        parts = list(word)
        while True:
            found = [(score[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in score]
            if not found:
                return [names[p] for p in parts]
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    pick = random.Random(8)
    words = ["".join(pick.choice("ab") for _ in range(pick.randint(1, 14))) for _ in range(2000)]
    symbols = np.array([names[c] for w in words for c in w], np.int32)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    got, word = pieces.merge_words(small, symbols, owner)
    assert [got[word == n].tolist() for n in range(0, 2000, 7)] == [one_by_one(w) for w in words[::7]]


def test_bytes_that_are_no_text(library):
    model = pieces.Model.of(piece_model_path())
    runs = [[3 + 0xC3, 3 + 0x28], [3 + 0xE2, 3 + 0x82], [3 + 0x80], [3 + 0xF0, 3 + 0x9F, 3 + 0x98, 259], [28705], [1, 264, 2]]
    ids, begin = np.concatenate(runs), np.cumsum([0] + [len(r) for r in runs])
    assert pieces.decode_batch(model, ids, begin)[:5] == [library.decode(r) for r in runs[:5]]
    with pytest.raises(ValueError, match="vocabulary"):
        pieces.decode_batch(model, np.array([32_000]), np.array([0, 1]))


def test_piece_columns(spark, library):
    docs = documents(spark, AWKWARD, clash=True).withColumn("ids", F.lit("x"))
    path = piece_model_path()
    rows = pieces.digest(pieces.decode(pieces.encode(docs, path), path)).collect()
    want = Counter()
    for n, t in enumerate(AWKWARD):
        doc, text = t if isinstance(t, tuple) else (n, t)
        ids = library.encode(text or "")
        want[doc, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
             sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert Counter(map(tuple, rows)) == want
    assert pieces.decode(pieces.encode(docs.limit(0), path), path).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert {(r.doc_id, r.text) for r in pieces.decode(none, path).collect()} == {(1, ""), (2, "")}


# --- op13 ------------------------------------------------------------------------


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = level[at // 2 * 2 : at // 2 * 2 + 2]
        out.append((at % 2, [run[1 - at % 2]] if len(run) == 2 else []))
        at //= 2
    return out


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> Counter of result rows."""
    parts = {}
    for r in rows:
        parts.setdefault(r[2], []).append(r)
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for p in names:
        own = sorted(parts[p], key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        parts[p], trees[p] = own, tree([brute_leaf(r) for r in own])
    top = tree([trees[p][-1][0] for p in names])
    out = Counter()
    for k, p in enumerate(names):
        for at, r in enumerate(parts[p]):
            path = siblings(trees[p], at) + siblings(top, k)
            bad = r[0] is not None and r[3] is not None and crc32(str(r[0]).encode()) % 7 == 0
            h = brute_leaf((r[0], r[1], r[2], r[3] + 1, r[4])) if bad else brute_leaf(r)
            for side, other in path:
                h = H(*other, h) if side else H(h, *other)
            root = top[-1][0]
            out[r[0], brute_leaf(r), trees[p][-1][0], root, H(*(o for _, other in path for o in other)), h, h == root] += 1
    return out


def manifest_rows(frame, **more):
    docs = frame.select(*FIELDS).withColumn("claimed", tampered_leaf())
    return Counter(map(tuple, merkle.verify(merkle.manifest(docs, FIELDS, carry=["claimed"], **more), claimed="claimed").collect()))


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_against_brute_force(spark, levels):
    pick = random.Random(levels)
    rows = [(n, pick.choice(["web", None, ""]), pick.choice(["en", "en", "en", "de", "ünï", "", None]), pick.choice([n, None]),
             pick.choice(["", None, f"text {n}", "é" * n])) for n in range(150)]
    rows += [(7, "web", "en", 1, "again")] * 30 + [(7, "web", "en", 1, "other"), (None, "s", "en", 4, "none"), (None, "s", None, None, None)]
    rows += [(1, "s", "alone", 3, "one leaf")]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    got = manifest_rows(frame.repartition(5).withColumn("_part", F.lit(1)).withColumn("leaf", F.lit(2)), levels=levels)
    assert got == brute_manifest(rows)
    assert {v for (*_, v) in got} == {True, False}


def test_manifest_of_blocks(spark):
    """Several blocks of full size, the last one short, and one part of exactly one block."""
    rows = [(n, "s", "en" if n % 4 else "de", n, f"t{n}") for n in range(4096)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert manifest_rows(frame) == brute_manifest(rows)


@pytest.mark.parametrize("count", [0, 1, 2])
def test_small_manifests(spark, count):
    rows = [(n, None, None, None, None) for n in range(count)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert manifest_rows(frame) == (brute_manifest(rows) if rows else Counter())


def test_witness_tells_a_changed_leaf(spark):
    rows = documents(spark, [prose(20, n) for n in range(9)])
    made = merkle.manifest(rows, FIELDS).collect()
    for r in made:
        assert merkle.fold(bytes.fromhex(r.leaf), r.witness).hex() == r.root
        assert merkle.fold(bytes(32), r.witness).hex() != r.root
