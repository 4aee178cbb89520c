"""The manifest, the conversation trie and packing against plain computations, and on odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pavelake.llm import bpe, merkle, packing, prefixes
from pavelake.llm.common import fold

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree int, path string, h int, key string, part int"
TURNS = "conv_id long, turn long, role string, text string, pos int, seq string, e int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# -- manifest -------------------------------------------------------------------------------------


def leaf_by_force(d, t, la, s, n):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, s, la, n, t)))


def climb(level):
    """(root, [(left, right) of each step] of each leaf)"""
    at, proofs = list(range(len(level))), [[] for _ in level]
    while len(level) > 1:
        for i, p in enumerate(at):
            run = level[p - p % 3: p - p % 3 + 3]
            proofs[i].append((run[:p % 3], run[p % 3 + 1:]))
            at[i] = p // 3
        level = [sha(*level[i: i + 3]) for i in range(0, len(level), 3)]
    return level[0], proofs


def manifest_by_force(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    trees = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        ordered = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_force(*r)))
        trees.append((ordered, *climb([leaf_by_force(*r) for r in ordered])))
    root, top = climb([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (ordered, subroot, proofs), above in zip(trees, top):
        for (d, t, la, s, n), proof in zip(ordered, proofs):
            before = leaf_by_force(d, t, la, s, n)
            tampered = d is not None and zlib.crc32(str(d).encode()) % 2 == 0 and t is not None
            now = leaf_by_force(d, t.replace("\n", ""), la, s, n) if tampered else before
            steps = proof + above
            for left, right in steps:
                now = sha(*left, now, *right)
            out.append((d, before, subroot, root, sha(*(x for left, right in steps for x in left + right)), now, now == root))
    return out


def manifest(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "p", 2, "k", 3) for r in rows], DOCS)
    proofs = merkle.manifest(docs, fold("doc_id", 2) == 0, F.translate("text", "\n", ""))
    return [tuple(r) for r in merkle.verified(proofs).collect()]


def text_order(rows):
    return sorted(rows, key=str)


ODD_ROWS = [(1, "a\nb", "x", "s", 3), (None, "q\n", None, None, 1), (None, "q\n", None, None, 1), (2, None, "x", None, 0),
            (5, "a", "x", "t", 3), (5, "a", "x", "t", 3), (5, "b", "x", "t", 3), (7, "", "é", "ü", None), (8, "l\n" * 40_000, "x", "s", 1)]


@pytest.mark.parametrize("rows", [
    ODD_ROWS + [(i, f"t\n{i}", "e", "big", i) for i in range(100, 400)], ODD_ROWS[:1], ODD_ROWS[:2], ODD_ROWS[:4], [],
    [(i, "one\ntext", "e", f"s{i}", i) for i in range(100)]])
def test_manifest_equals_brute_force(spark, rows):
    found = manifest(spark, rows)
    assert text_order(found) == text_order(manifest_by_force(rows))


def test_ancestors_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    rows = [(i, f"t\n{i}", "e", "big" if i % 3 else f"s{i % 7}", i) for i in range(700)] + ODD_ROWS
    assert text_order(manifest(spark, rows)) == text_order(manifest_by_force(rows))


def test_a_changed_row_and_a_changed_sibling_do_not_verify(spark):
    rows = [(i, f"t{i}", "e", "s", i) for i in range(30)]
    docs = spark.createDataFrame([(*r, 1, "p", 2, "k", 3) for r in rows], DOCS)
    proofs = merkle.manifest(docs, F.col("doc_id") == 4, F.lit("other"))
    assert {r.doc_id for r in merkle.verified(proofs).where("NOT verified").collect()} == {4}
    wrong = proofs.withColumn("path", F.transform("path", lambda s: F.overlay(s, F.unhex(F.lit("00ff")), 2)))
    assert merkle.verified(wrong).where("verified").count() == 0


# -- conversation trie ----------------------------------------------------------------------------


def trie_by_force(rows):
    told = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            told[c].append((t is not None, t or 0, sha(f"{len(r.encode())}:", r, x)[:32], r, x))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in told.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        made[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[made[c][:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += not children[p]
    return [(m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
             sha(",".join(str(c) for c in m if made[c] == p))) for p, m in members.items()]


def trie(spark, rows):
    told = prefixes.sequences(spark.createDataFrame([(*r, 1, "q", 2) for r in rows], TURNS))
    return [tuple(r) for r in prefixes.trie(prefixes.rebuilt(told)).collect()]


def conversations(seed, n):
    rng, rows = random.Random(seed), []
    for c in range(-20, n):
        for t in range(rng.choice([1, 1, 2, 3, 4, 6, 30])):
            rows.append((c, t, "u" if t % 2 else None, rng.choice(["a", "a b", None, "a  b\nc"]) if rng.random() < 0.3 else "a"))
    return rows


@pytest.mark.parametrize("block", [5, 1024])
def test_trie_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(prefixes, "BLOCK", block)
    monkeypatch.setattr(prefixes, "IDS", 3)
    rows = conversations(block, 250)
    assert text_order(trie(spark, rows)) == text_order(trie_by_force(rows))


@pytest.mark.parametrize("rows", [
    [], [(5, 0, "u", "x")], [(1, 0, None, None)], [(None, 0, "u", "x")], [(None, 1, "u", "x"), (3, None, "u", "x"), (3, 0, "u", "y")],
    [(3, 1, "u", "x"), (3, 1, "u", "x"), (3, 1, "v", "x"), (23, 1, "u", "x")], [(7, t, "u", "word " * 20_000) for t in range(6)],
    [(c, t, "u", "same") for c in range(60) for t in range(3)]])
def test_trie_on_odd_rows(spark, rows):
    assert text_order(trie(spark, rows)) == text_order(trie_by_force(rows))


def test_searches_on_the_sparse_table():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 64, 100):
        values = rng.integers(0, 6, n)
        table = prefixes.sparse_table(values)
        begins, bound = rng.integers(0, n, 200), rng.integers(0, 7, 200)
        found = prefixes.first_below(table, begins, bound)
        for b, d, f in zip(begins, bound, found):
            assert f == next((i for i in range(b, n) if values[i] < d), n)
        ends = begins + rng.integers(0, n, 200) % (n - begins + 1)
        minima = prefixes.range_minima(table, begins, ends, 99)
        assert all(m == (values[b:e].min() if e > b else 99) for b, e, m in zip(begins, ends, minima))


# -- packing --------------------------------------------------------------------------------------


def check_packing(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, block int, tokens int")
    pieces = packing.pack(docs, ids=True, **options).collect()
    assert len(pieces) == packing.pack(docs, **options).count()
    tokenizer = bpe._tokenizer(bpe.VOCABULARY)
    want = collections.Counter((d, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1) for d, t in rows)
    documents, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) > 0 and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        documents[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    unique = {d for d, n in collections.Counter(d for d, _ in rows).items() if n == 1}
    for d in unique:
        parts = sorted(documents[d], key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts])[:-1])
        ids = [i for p in parts for i in p.ids]
        assert want[(d, *ids)] == 1 and {p.doc_tokens for p in parts} == {len(ids)}
    assert sum(p.length for p in pieces) == sum((len(k) - 1) * n for k, n in want.items())
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == list(np.cumsum([0] + [p.length for p in parts])[:-1])
        total = sum(p.length for p in parts)
        assert total == parts[0].context <= options.get("window", 2048) and total & (total - 1) == 0
    groups = collections.Counter()
    for parts in sequences.values():
        groups[parts[0].step_group] += parts[0].context
    assert all(n <= options.get("step_tokens", packing.STEP_TOKENS) for n in groups.values())
    return sequences


def test_packing_holds_every_token_once(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["word", "another", "über", "x1"], k=rng.choice([0, 1, 20, 300, 900, 5000])))) for i in range(200)]
    sequences = check_packing(spark, rows)
    small = [s for s in sequences.values() if s[0].context < packing.SMALLEST]
    assert len(small) <= 8  # what is left of the only block


def test_packing_on_odd_rows(spark):
    odd = [(1, None), (2, ""), (3, " \n"), (None, "one"), (None, "one"), (4, "x" * 50_000), (5, " " * 30_000 + "a"), (6, "same"), (6, "same"),
           (7, "a<|endoftext|>b <|endoftext|>"), (8, "漢字 Ა Ა new\U0001F600"), (9, "it's we'll 's")]
    check_packing(spark, odd)
    check_packing(spark, [])
    check_packing(spark, odd, window=64, smallest=16, step_tokens=128)
    with pytest.raises(ValueError):
        packing.sizes(100, 10)


def test_whole_rests_are_kept_where_they_fit():
    lengths = [1500, 400, 148, 900, 124]
    made = packing.packed(lengths, [2048, 1024])
    assert sorted(map(tuple, (sorted(p) for p in made))) == [((0, 0, 1500), (1, 0, 400), (2, 0, 148)), ((3, 0, 900), (4, 0, 124))]


def test_fast_encoding_equals_the_tokenizer():
    tokenizer, encode = bpe._tokenizer(bpe.VOCABULARY), bpe.encoder()
    rng, letters = random.Random(7), " '  \n\tst re ve ll dma1٣!?,é漢 　\U0001F600-"
    for text in ["", "a<|endoftext|>b", " " * 20_000, "\n" * 12_000 + "x"] + ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(2000)]:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
