"""Each operator against a plain computation, and on the odd cases: nulls, empty and long texts, ties, repeated rows,
empty tables, and further columns whose names the operators use themselves."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pavelake.llm import arrays, bpe, components, dartminhash, decontam, embeddings, langid, licenses, passages, secrets
from pavelake.llm import suffixtree, toxicity
from pavelake.llm.common import narrow_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, block int, key string, words string, row int"
WORDS = "ab cd ef gh ij kl mn op qr st uv wx yz ba dc fe hg ji lk nm po rq ts vu xw zy".split()


def frame(spark, rows):
    """rows: (doc_id, text[, lang, source])"""
    full = [(*r, *(None,) * (4 - len(r)))[:4] for r in rows]
    return spark.createDataFrame([(d, t, la, s, len(t or ""), "x", 1, "k", "w", 7) for d, t, la, s in full], SCHEMA)


def prose(seed, n):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "é€ 漢字 \U0001F600"), (6, "x" * 50_000), (7, prose(1, 30_000)),
       (8, "one"), (8, "one"), (None, "one"), (9, "�\u0000a")]


# -- BPE ------------------------------------------------------------------------------------------


def test_bpe_equals_the_tokenizer(spark):
    tokenizer = bpe._tokenizer(bpe.VOCABULARY)
    texts = [t for _, t in ODD] + ["it's we'll I'd 'sfoo  's \n's '' 's", "a<|endoftext|>b <|endoftext|>", "a  b\n\n c\t \t1234 !?x", "Ᲊa new letter"]
    letters = " '  \n\tst re ve ll dma1٣!?, 　"
    rng = random.Random(2)
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(300)]
    docs = frame(spark, list(enumerate(texts)))
    found = {r.doc_id: r for r in bpe.encode(docs, decoded=True).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i].ids == tokenizer.encode(text or "", add_special_tokens=False).ids
        assert found[i].decoded == tokenizer.decode(found[i].ids, skip_special_tokens=False)
    again = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs)).collect()}
    assert all(again[i] == (t or "") for i, t in enumerate(texts))


def test_bpe_keeps_repeated_and_null_keys_and_takes_an_empty_table(spark):
    found = bpe.digest(frame(spark, ODD)).collect()
    assert collections.Counter(r.doc_id for r in found) == collections.Counter(d for d, _ in ODD)
    empty = next(r for r in found if r.doc_id == 1)
    assert (empty.n_tokens, empty.ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
    assert bpe.digest(frame(spark, [])).count() == 0


def test_bpe_hands_a_block_on_in_batches_of_few_ids(monkeypatch):
    monkeypatch.setattr(bpe, "IDS_AT_ONCE", 50)
    texts = [prose(i, n) for i, n in enumerate((5, 0, 40, 1, 200, 3, 90))] + [""]
    block = pd.DataFrame({"block": 0, "key": [4, 2, None, 1, 1, 7, 8, 9], "text": texts})
    dealt = pa.table({"keys": pa.array([[4, 2, None, 1], [1, 7, 8, 9]], pa.list_(pa.int64()))})
    packed = pd.concat(bpe._pack_texts(iter([block[:4], block[4:]])))
    for name in ("sizes", "texts"):
        dealt = dealt.append_column(name, pa.array(packed[name].tolist(), pa.binary()))
    words = bpe._list_words(bpe.VOCABULARY, 16)(packed)
    encoded = pd.concat(bpe._encode_words(bpe.VOCABULARY)(iter([words])))
    out = bpe._place_ids(bpe.VOCABULARY, 16, ("ids", "n_tokens"))(dealt, pa.Table.from_pandas(encoded, preserve_index=False))
    tokenizer = bpe._tokenizer(bpe.VOCABULARY)
    assert out["key"].to_pylist() == [4, 2, None, 1, 1, 7, 8, 9]
    assert out["ids"].to_pylist() == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    most = max(out["n_tokens"].to_pylist())
    assert len(out.to_batches()) > 1 and all(sum(b["n_tokens"].to_pylist()) <= 50 + most for b in out.to_batches())


def test_bpe_keeps_no_table_of_another_step_while_it_places_ids():
    bpe.encoder()
    test = pa.table({"keys": pa.array([[1]], pa.list_(pa.int64())), "sizes": [bpe._packed(np.array([0]))], "texts": [bpe._packed(b"")]})
    none = pa.table({"bucket": pa.array([], pa.int32()), "sizes": pa.array([], pa.binary()), "ids": pa.array([], pa.binary())})
    assert bpe._place_ids(bpe.VOCABULARY, 16, ("ids",))(test, none).to_pydict() == {"key": [1], "ids": [[]]}
    assert not bpe._by_rank.cache_info().currsize


def test_a_worker_gives_back_what_was_freed():
    held = lambda: int(re.search(r"VmRSS:\s+(\d+)", open("/proc/self/status").read())[1]) / 1024
    arrays.only("bpe")
    parts = [bytes(2_000) for _ in range(100_000)]  # 200 MB in pieces, every tenth page of which stays in use
    parts = parts[::500]
    before = held()
    arrays.give_back()
    assert held() < before - 100 and len(parts) == 200


def test_bpe_takes_a_table_of_empty_texts(spark):
    found = bpe.digest(frame(spark, [(1, None), (2, ""), (None, "")]), ids=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids) for r in found) == [("1", 0, []), ("2", 0, []), ("None", 0, [])]


# -- near-duplicates ------------------------------------------------------------------------------


def groups_by_force(rows, least):
    bags = {}
    for d, t in rows:
        w = (t or "").lower().split()
        n = min(5, len(w))
        bags[d] = collections.Counter(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if w else collections.Counter()
    group = {d: d for d in bags}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(sorted(bags), 2):
        either = sum((bags[a] | bags[b]).values())
        if either and sum((bags[a] & bags[b]).values()) / either >= least:
            x, y = top(a), top(b)
            group[max(x, y)] = min(x, y)
    return {d: top(d) for d in bags}


def near_copies():
    rng, rows = random.Random(5), []
    for g in range(12):
        base = prose(100 + g, rng.randint(8, 200)).split()
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(WORDS)
            rows.append((len(rows) + 100, " ".join(text)))
    hot = prose(9, 150).split()
    for _ in range(60):  # a large group of which many pairs are below the threshold
        text = list(hot)
        for _ in range(rng.randint(1, 6)):
            text[rng.randrange(len(text))] = rng.choice(WORDS)
        rows.append((len(rows) + 100, " ".join(text)))
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = near_copies() + [(1, None), (2, ""), (3, "one"), (4, "ONE "), (5, "two words"), (6, "a b a b a b a b " * 50)]
    found = {r.doc_id: r for r in dartminhash.near_duplicates(frame(spark, rows)).collect()}
    wanted = groups_by_force(rows, 0.8)
    assert {d: r.group_id for d, r in found.items()} == wanted
    assert {d for d, r in found.items() if r.kept} == {d for d, g in wanted.items() if d == g}
    left = dartminhash.one_of_each(frame(spark, rows))
    assert left.columns == frame(spark, []).columns and left.count() == len(set(wanted.values()))


def test_near_duplicates_on_odd_rows(spark):
    found = dartminhash.near_duplicates(frame(spark, ODD)).collect()
    assert len(found) == len(ODD)
    kept = {r.doc_id: r.kept for r in found}
    assert kept[1] and kept[2] and kept[None] and kept[4] and not kept[8]
    assert dartminhash.near_duplicates(frame(spark, [])).count() == 0


def test_signatures_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(1)
    worst = []
    for _ in range(30):
        n = int(rng.integers(20, 400))
        h = rng.integers(0, 2**63, size=n).astype(np.uint64)
        a = rng.integers(0, 5, size=n)
        b = np.where(rng.random(n) < 0.7, a, rng.integers(0, 5, size=n))
        wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        x, y = dartminhash.signatures([(h[a > 0], a[a > 0]), (h[b > 0], b[b > 0])], 400)
        worst.append(abs((x == y).mean() - wanted) / math.sqrt(wanted * (1 - wanted) / 400))
    assert max(worst) < 4.5 and np.mean(worst) < 1.2


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(203, 201), (201, 202), (202, 203), (7, 7), (None, 3)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, **{i: 201 for i in (201, 202, 203)}}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# -- embeddings -----------------------------------------------------------------------------------


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, schema = [], "vec_id long, embedding array<float>, label int, rep string, n string, vector string"
    for g in range(15):
        base = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 8))):
            x = base + rng.standard_normal(16) * 0.05
            rows.append([x.astype(np.float32).tolist(), int(g % 3)])
    hot = rng.standard_normal(16)
    rows += [[(hot + rng.standard_normal(16) * 0.06).astype(np.float32).tolist(), 1] for _ in range(300)]  # over one block
    rows += [[[1.0] * 16, 2]] * 40 + [[None, 1], [[0.0] * 16, 1], [[float("nan")] * 16, 1], [[float("inf")] + [1.0] * 15, 1], [[], 1],
                                      [[None] + [1.0] * 15, 1], [[1.0] * 16, None], [[1.0] * 8, 2]]
    data = [(i, v, la, "r", "n", "v") for i, (v, la) in enumerate(rows)]
    found = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(data, schema)).collect()}
    good = lambda v: v and None not in v and np.isfinite(v).all() and np.any(v)
    unit = {i: np.array(v, float) / np.linalg.norm(v) for i, v, *_ in data if good(v)}
    links = collections.defaultdict(set)
    for (i, v, la, *_), (j, w, lb, *_) in itertools.combinations(data, 2):
        if la is not None and la == lb and i in unit and j in unit and len(v) == len(w) and unit[i] @ unit[j] >= 0.98:
            links[i].add(j), links[j].add(i)
    for i, *_ in data:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (len(links[i]), min(seen), i == min(seen)), i
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).count() == 0


# -- passages -------------------------------------------------------------------------------------


def test_passages_equal_brute_force(spark):
    rng = random.Random(11)
    shared = [" ".join(f"p{g}w{i}" for i in range(rng.choice([49, 50, 55, 80, 120]))) for g in range(8)]
    rows = []
    for d in range(60):
        own = [f"d{d}w{i}" for i in range(rng.randint(0, 120))]
        cut = rng.randint(0, len(own))
        rows.append((d, " ".join(own[:cut] + rng.choice(shared).upper().split() + own[cut:])))
    rows += [(90, None), (91, ""), (92, " ".join(["same"] * 300)), (93, shared[0]), (93, shared[0]), (None, shared[1])]
    own = collections.defaultdict(set)
    for d, t in rows:
        w = (t or "").lower().split()
        if d is not None:
            for i in range(len(w) - 49):
                own[tuple(w[i: i + 50])].add(d)
    wanted = {}
    for d, t in rows:
        w, spans = (t or "").lower().split(), []
        for i in range(len(w) - 49):
            if d is not None and len(own[tuple(w[i: i + 50])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 50
                else:
                    spans.append([i, i + 50])
        if spans:
            wanted[d] = [tuple(s) for s in spans]
    found = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in passages.repeated(frame(spark, rows)).collect()}
    assert found == wanted
    assert passages.repeated(frame(spark, [])).count() == 0


def passages_by_force(rows):
    own, wanted = collections.defaultdict(set), {}
    texts = [(d, t.lower().split()) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - 49):
            own[tuple(w[i: i + 50])].add(d)
    for d, w in texts:
        spans = []
        for i in range(len(w) - 49):
            if len(own[tuple(w[i: i + 50])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 50
                else:
                    spans.append([i, i + 50])
        if spans:
            wanted[d] = [tuple(s) for s in spans]
    return wanted


def passages_found(docs):
    return {r.doc_id: [(s.start, s.end) for s in r.spans] for r in passages.repeated(docs).collect()}


def test_passages_that_a_document_repeats_meet_a_holder_in_another_batch(spark):
    own = lambda d, k: " ".join(f"d{d}k{k}w{i}" for i in range(30))
    rows = []
    for g in range(12):
        shared = " ".join(f"g{g}w{i}" for i in range(60 + 15 * g))
        rows += [(2 * g, " ".join([own(g, 0), shared, own(g, 1), shared, own(g, 2), shared, own(g, 3)])), (2 * g + 1, shared)]
    wanted = passages_by_force(rows)
    assert all(len(wanted[2 * g]) == 3 for g in range(12))
    with narrow_batches(spark, 1):
        assert passages_found(frame(spark, rows)) == wanted


def test_passages_with_few_distinct_endings_and_stretches_that_overlap(spark):
    rng = random.Random(12)
    notice = [f"n{i}" for i in range(45)]
    own = lambda d, n: [f"d{d}w{i}" for i in range(n)]
    rows = [(d, " ".join(own(d, 7) + notice + [f"e{d % 10}w{i}" for i in range(10)] + own(d, 40)[7:])) for d in range(150)]
    whole = [f"s{i}" for i in range(160)]
    for d in range(200, 320):
        a = rng.randint(0, 90)
        rows.append((d, " ".join(own(d, 9) + whole[a: a + rng.randint(48, 70)] + own(d, 30)[9:])))
    with narrow_batches(spark, 7):
        assert passages_found(frame(spark, rows)) == passages_by_force(rows)


# -- decontamination and licences -----------------------------------------------------------------


def test_contained_items(spark):
    long = prose(21, 400)
    item = prose(22, 40)
    part = " ".join(item.split()[:30])
    big = prose(25, 300)
    items = spark.createDataFrame([(1, item, "x"), (2, "only three words", "x"), (3, None, "x"), (4, "", "x"), (None, item, "x"), (5, big, "x")],
                                  "item_id long, text string, doc string")
    rows = [(10, f"{long} {item.upper()} {long}"), (11, f"{long} {part} {long}"), (12, long), (13, "only  three\nWORDS"), (14, None),
            (15, " ".join(big.split()[:280])), (15, "again"), (None, item)]
    found = {(r.doc_id, r.item_id): r.containment for r in decontam.contained(frame(spark, rows), items).collect()}
    assert set(found) == {(10, 1), (13, 2), (15, 5)} and found[10, 1] == 1.0 and 0.8 <= found[15, 5] < 1
    left = decontam.clean(frame(spark, rows), items)
    assert left.columns == frame(spark, []).columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 11, 12, 14]
    assert decontam.contained(frame(spark, []), items).count() == 0
    assert decontam.contained(frame(spark, rows), items.limit(0)).count() == 0


def test_licences(spark):
    mit = max((t for n, t in licenses.TEMPLATES if n == "MIT"), key=len)
    block = mit.replace("furnished", "provided").replace(", ", ",\n")
    rows = [(1, "the first line is here\nReleased under the MIT license!\nand here is the last"), (2, f"intro\n\n{block}\n\nend"), (3, "Released under the moon."), *ODD]
    found = {(r.doc_id, r.unit, r.place): r for r in licenses.scan(frame(spark, rows)).collect()}
    assert set(found) == {(1, "line", 1), (2, "block", 1)}
    assert found[1, "line", 1].license_id == "MIT" and found[1, "line", 1].dice == 1.0 and 0.8 <= found[2, "block", 1].dice < 1
    assert licenses.scan(frame(spark, [])).count() == 0
    assert licenses.scan(frame(spark, rows), licenses.templates(spark).limit(0)).count() == 0


def test_licences_and_versions_are_told_apart(spark):
    """Every template as a line, in capitals and without its last word where it is long, is its own licence."""
    rows = []
    for i, (_, text) in enumerate(licenses.TEMPLATES):
        rows += [(2 * i, f"before\n{text.upper()}\nafter"), (2 * i + 1, text.rsplit(" ", 1)[0] if len(text.split()) > 30 else text)]
    found = {r.doc_id: r.license_id for r in licenses.scan(frame(spark, rows)).collect() if r.unit == "line"}
    assert found == {d: licenses.TEMPLATES[d // 2][0] for d, _ in rows}


# -- secrets --------------------------------------------------------------------------------------


def test_secrets(spark):
    shared, own, hexes = "EXAMPLEKEY0123456", "sk_live_0a1b2c3d4e5f", "0123456789abcdef0"
    rows = [(i, f"é\U0001F600 token = \"{shared}\"", None, f"s{i}") for i in range(5)]
    rows += [(10, f"PassWord: {own} and password:short {hexes}x", None, "s1"), (11, "AKIA" + "A" * 14 + " token=secret=abcdefghijkl", None, None),
             (12, "-----BEGIN RSA PRIVATE KEY-----", None, "s2"), (13, None, None, "s3"), (13, None, None, "s3"), (None, f"token={own}", None, "s1")]
    found = collections.defaultdict(list)
    for r in secrets.digest(secrets.scan(frame(spark, rows))).collect():
        found[r.doc_id].append(r)
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for d, text, *_ in rows:
        t = text or ""
        spans = [(m.start(), 0, m.end()) for m in pattern.finditer(t) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert found[d][0].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert found[0][0].n_live == 0 and found[0][0].n_assign == 1  # three owners make an example
    assert found[10][0].n_live == 2 and found[12][0].spans == "pem:0:31" and len(found[13]) == 2
    masked = {r.doc_id: r for r in secrets.mask(frame(spark, rows)).collect()}
    assert masked[10].text == "[secret] and password:short [secret]x" and masked[10].n_chars == len(masked[10].text)
    assert masked[0].text == rows[0][1] and masked[13].text is None
    assert secrets.scan(frame(spark, [])).count() == 0 and secrets.mask(frame(spark, [])).count() == 0


def test_a_secret_that_one_owner_copies_is_masked(spark):
    own, example = "sk_live_0a1b2c3d4e5f", "EXAMPLEKEY0123456"
    rows = [(d, f"token={own} end", None, "hot") for d in range(25)] + [(30 + d, f"token={example} end", None, f"s{d % 3}") for d in range(25)]
    masked = {r.doc_id: r.text for r in secrets.mask(frame(spark, rows)).collect()}
    assert all(masked[d] == "[secret] end" for d in range(25))
    assert all(masked[30 + d] == f"token={example} end" for d in range(25))


# -- learned operators ----------------------------------------------------------------------------


def languages(n=160):
    rng, rows = random.Random(8), []
    parts = {"aa": "ka lo mi tu re".split(), "bb": "sch ein ung ver ach".split(), "cc": "ñ ción mente os ez".split()}
    for d in range(n):
        lang = list(parts)[d % 3]
        rows.append((d, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(3, 80))), lang))
    return rows


def test_language_id(spark):
    rows = languages()
    docs = frame(spark, rows + [(900, None), (901, ""), (902, "123 !?"), (903, "kalo", None), (None, "kamitu")])
    learned = langid.samples(docs)
    assert [n for n, _ in learned] == ["aa", "bb", "cc"]
    found = {r.doc_id: r for r in langid.identify(docs, learned).select("*", "language.*").drop("language").collect()}
    assert {found[d].lang_pred for d in (900, 901, 902)} == {"und"} and found[903].lang_pred == "aa"
    assert sum(found[d].lang_pred == la for d, _, la in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in found.values()) and set(docs.columns) <= set(langid.identify(docs, learned).columns)
    assert langid.identify(frame(spark, []), langid.samples(frame(spark, []))).count() == 0


@pytest.mark.parametrize("dense", [0, 2, 40])
def test_greedy_parse_takes_longest_known_phrases(monkeypatch, dense):
    """Whatever share of the letters is in the table and not searched for."""
    monkeypatch.setattr(langid, "DENSE", dense)
    rng = random.Random(dense)
    train = "".join(rng.choices("abcdef漢字語", k=400))
    texts = ["".join(rng.choices("abcdef漢字語zé", k=rng.randint(1, 60))) for _ in range(50)] + ["漢", "z", "zz"]
    parser = langid.Parser({"xx": train})
    found = parser.phrases([parser.symbol[langid._letters(t)].astype(np.int64) for t in texts])[0]
    for text, phrases in zip(texts, found):
        wanted, at = 1, 0
        while at < len(text):
            n = 0
            while at + n < len(text) and text[at: at + n + 1] in train:
                n += 1
            # a letter that the training text lacks ends a phrase, and the next one starts after it
            at, wanted = at + max(n, 1) if n == 0 or at + n == len(text) or text[at + n] in train else at + n + 1, wanted + (at + n < len(text))
        assert phrases == wanted


def test_scripts_of_any_size_are_told_apart_and_kept(spark):
    rng, rows = random.Random(5), []
    starts = {"latin": 0x61, "greek": 0x3B1, "cyrillic": 0x430, "arabic": 0x628, "hindi": 0x915, "korean": 0xAC00, "chinese": 0x4E00}
    for k, (name, start) in enumerate(starts.items()):
        letters = [chr(start + i) for i in range(20 if start < 0xA000 else 2500)]
        words = ["".join(rng.choices(letters, k=rng.randint(2, 5))) for _ in range(400)]
        rows += [(1000 * k + i, " ".join(rng.choices(words, k=60)), name) for i in range(100)]
        rows.append((1000 * k + 500, words[0], None))
    docs = frame(spark, rows)
    judged = langid.identify(docs, langid.samples(docs), into="__v").select("doc_id", "lang", "__v.lang_pred", langid.accepted("__v").alias("kept")).collect()
    for name in starts:
        of = [r for r in judged if r.lang == name]
        assert sum(r.lang_pred == name for r in of) >= 0.95 * len(of) and sum(r.kept for r in of) >= 0.95 * len(of)
    assert sum(r.kept for r in judged if r.lang is None) == len(starts)  # one word of a language is not too short


def test_a_column_of_the_user_survives_the_first_stage(spark):
    import corpus_pipeline

    docs = frame(spark, languages()).withColumns({"score": F.lit(7.5), "language": F.lit("mine"), "lang_pred": F.lit(1)})
    out = corpus_pipeline.language(spark, docs, "")
    assert out.columns == docs.columns and out.select("score", "language", "lang_pred").distinct().collect() == [(7.5, "mine", 1)]


def test_toxicity_learns_nothing_from_held_out_labels_or_other_columns(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(WORDS, k=30) + (["vileword"] * 2 if i % 3 == 0 else [])), rng.choice("ab"), rng.choice("st")) for i in range(400)]
    docs = frame(spark, rows)
    labels = [(i, int(i % 3 == 0)) for i in range(400)]
    turned = [(i, 1 if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    scores = []
    for lab, table in ((labels, docs), (turned, docs.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string")}))):
        model = toxicity.learn(table, spark.createDataFrame(lab, "doc_id long, toxic int"))
        scores.append({r.doc_id: r.score for r in toxicity.score(table, model).collect()})
    assert scores[0] == scores[1] and len(set(scores[0].values())) > 1


def test_repeated_rows_and_null_keys_are_masked_and_not_multiplied(spark):
    secret = "password: abcdefgh12345678"
    rows = [(1, secret, "aa", "s1"), (1, secret, "aa", "s1"), (None, "x " + secret, "aa", "s1"), (2, "clean", "aa", "s1"), (3, None)]
    out = [r.text for r in secrets.mask(frame(spark, rows)).collect()]
    assert sorted(map(str, out)) == ["None", "[secret]", "[secret]", "clean", "x [secret]"]


def test_lm_scores_against_plain_counts(spark):
    rows = [(d, t) for d, t, _ in languages(60)] + [(900, None), (901, ""), (902, "Ka  LO\tka"), (903, "�é")]
    found = {r.doc_id: r for r in suffixtree.score(frame(spark, rows)).collect()}
    tokens = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + [None]
    counts = collections.Counter(w for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for d, t in rows:
        w, r = tokens(t), found[d]
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), abs=1e-8)
        assert r.score < 0
    assert suffixtree.score(frame(spark, [])).count() == 0


def test_lm_scores_equal_brute_force(spark):
    """Contexts, divergence tests and smoothing over words by dictionaries; the byte tree is compared below."""
    phrases = [" ".join(f"p{k}q{j % 5}" for j in range(12)) for k in range(12)]
    rng = random.Random(9)
    rows = [(d, " ".join([prose(d, 15), rng.choice(phrases), prose(d + 500, 5), rng.choice(phrases)])) for d in range(80)]
    rows += [(200, rows[0][1]), (201, ""), (202, "AB cd"), (203, None), (204, "never seen words"), (None, rows[1][1])]
    found = {r.doc_id: r.score for r in suffixtree.score(frame(spark, rows)).collect()}
    learned = [t or "" for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    split = lambda t: (t or "").lower().split() + [None]
    buckets = {}
    for _, t in rows:
        _, _, b, _, _ = next(suffixtree._tokens([t or ""]))
        buckets.update(zip(split(t), b.tolist()))
    counts, follow = collections.Counter(), collections.defaultdict(collections.Counter)
    for w in map(split, learned):
        for size in (1, 2, 3):
            for i in range(len(w) - size + 1):
                gram = tuple(w[i: i + size])
                counts[gram] += 1
                if size < 3:
                    follow[gram][buckets[w[i + size]] if i + size < len(w) else 0] += 1
    words = sum(n for g, n in counts.items() if len(g) == 1 and g[0])
    share = collections.Counter()
    for gram in follow:
        if len(gram) == 1 and gram[0]:
            share.update(follow[gram])

    def keep(gram):
        n = counts[gram]
        if n < suffixtree.SEEN:
            return False
        gain = sum(m * math.log(m / ((share[b] + 1) / (words + 16)) / n) for b, m in follow[gram].items())
        return gain - len(follow[gram]) * math.log(16) >= suffixtree.GAIN * n

    tree = suffixtree.Tree(suffixtree.grow(spark.createDataFrame([(t,) for t in learned], "text string")))
    total, used = words + len(learned), collections.Counter()
    for d, t in rows:
        w, spelt, score = split(t), tree.word_logs([t or ""]), 0.0
        for i, x in enumerate(w):
            p = (1 - suffixtree.NEW) * counts[x,] / total + suffixtree.NEW * 10 ** spelt[i]
            if i and keep((w[i - 1],)):
                used[1] += 1
                p = (counts[w[i - 1], x] + suffixtree.PRIOR * p) / (counts[w[i - 1],] + suffixtree.PRIOR)
            if i > 1 and keep((w[i - 2],)) and keep((w[i - 2], w[i - 1])):
                used[2] += 1
                p = (counts[w[i - 2], w[i - 1], x] + suffixtree.PRIOR * p) / (counts[w[i - 2], w[i - 1]] + suffixtree.PRIOR)
            score += math.log10(p)
        assert found[d] == pytest.approx(score, abs=1e-7)
    assert used[1] > 100 and used[2] > 100


def test_lm_scores_on_odd_rows_and_copies(spark):
    """Repeated rows are scored alike, long texts whole; a text learned twice is likelier than one learned never."""
    long = prose(31, 30_000)
    rows = [*ODD, (20, long), (21, long + " tail"), (None, None), (20, long)]
    found = suffixtree.score(frame(spark, rows)).collect()
    assert collections.Counter(r.doc_id for r in found) == collections.Counter(d for d, _ in rows)
    assert len({r.score for r in found if r.doc_id == 20}) == len({r.score for r in found if r.doc_id == 8}) == 1
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    odd = {d: t for d, t in rows}
    assert all(r.n_tokens == len((odd[r.doc_id] or "").split()) + 1 for r in found if r.doc_id in (1, 2, 3, 20, 21))
    vocabulary = [f"w{i}" for i in range(3_000)]
    text = lambda seed: " ".join(random.Random(seed).choices(vocabulary, k=200))
    other = [(d, text(d)) for d in range(100, 160)]
    twice = [d for d in (10, 11, 12, 13, 14, 15) if zlib.crc32(str(d).encode()) % 5 != 1][:2]
    unseen = next(d for d in range(50, 90) if zlib.crc32(str(d).encode()) % 5 == 1)
    scores = {r.doc_id: r.score for r in suffixtree.score(frame(spark, [*other, *((d, text(7)) for d in twice), (unseen, text(8))])).collect()}
    assert scores[twice[0]] == scores[twice[1]] > scores[unseen] + 100


def test_tree_scores_equal_a_direct_search_of_the_longest_context(spark):
    texts = [t for _, t, _ in languages(60)]
    tree = suffixtree.Tree(suffixtree.grow(spark.createDataFrame([(t,) for t in texts], "text string")))
    assert any(m == suffixtree.DEPTH for m, _ in tree.nodes)
    by_node = {}
    for text in texts[:3] + ["", "zzz ka", prose(3, 3000)]:
        s = suffixtree.sequence(text)
        padded = [suffixtree.END] * suffixtree.DEPTH + s.tolist()
        state, total = 0, 0.0
        for x in padded[: suffixtree.DEPTH]:
            state = tree.moves[state + tree.symbol[x]]
        logs = []
        for at, x in enumerate(s.tolist()):
            context = 0
            for y in padded[at: at + suffixtree.DEPTH]:
                context = (context << 8) | y
            longest = next(n for k in range(suffixtree.DEPTH, -1, -1) if (n := (k, context & ((1 << 8 * k) - 1))) in tree.nodes)
            # all histories that end in the same longest kept context are scored alike
            row = tree.logs[state: state + tree.width]
            assert (by_node.setdefault(longest, row) == row).all()
            logs.append(row[tree.symbol[x]])
            state = tree.moves[state + tree.symbol[x]]
        assert tree.word_logs([text]).sum() == pytest.approx(sum(logs), abs=1e-6)
        assert len(tree.word_logs([text])) == len(text.split()) + 1
    different = {r.tobytes() for r in by_node.values()}
    assert len(different) > 0.9 * len(by_node) > 10


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for d in range(400):
        words = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(rng.randint(10, 60))]
        bad = d % 4 == 0
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["wretched", "horrible", "villain"]))
        rows.append((d, " ".join(words)))
        labels.append((d, 1, int(bad)))
    labels += [(3, 1, None), (None, 0, 1), (7_000, 0, 1)]
    docs, known = frame(spark, rows + [(900, None), (901, ""), (902, "you wretche and horible vilain " + prose(1, 20)),
                                       (903, 'they wrote "wretched horrible villain" ' + prose(1, 20)), (None, "x")]), \
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, known)
    assert {"wretched", "horrible", "villain"} <= set(model.lexicon.words)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert sum(found[d].predicted == int(d % 4 == 0) for d, _ in rows) >= 0.98 * len(rows)
    assert found[902].predicted == 1 and found[902].score > found[903].score and found[901].predicted == 0
    assert found[900].score == found[901].score and all(0 <= r.score <= 1 for r in found.values())
    nothing = toxicity.learn(frame(spark, []), known.limit(0))
    assert toxicity.score(docs, nothing).where("predicted = 1").count() == 0


def test_levenshtein_automaton_equals_edit_distance():
    lexicon = toxicity.Lexicon(["horrid", "hor", "villain"], ["hob"])

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(6)
    words = ["".join(rng.choices("horidvlanb", k=rng.randint(1, 9))) for _ in range(3000)]
    for base in ("horrid", "villain", "hor", "hobby"):
        words += [base, base[1:], base[:-1], base + "x", "x" + base, base[:2] + "z" + base[2:], base[:2] + "z" + base[3:]]
    exact, near, stem = lexicon.look_up([toxicity._codes(w) for w in words])
    for w, e, n, s in zip(words, exact, near, stem):
        assert e == (w in lexicon.words)
        assert n == (not e and min(distance(w, t) for t in ("horrid", "villain")) <= 1), w
        assert (s >= 0) == w.startswith("hob")


# -- pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages_and_run(spark, tmp_path):
    import corpus_pipeline

    rows = languages(120)
    item = " ".join(f"q{i}" for i in range(20))
    rows += [(500, rows[0][1], "aa", "s1"), (501, None), (502, "123 456"), (503, rows[3][1] + " " + item, "aa", "s1"),
             (504, " ".join(reversed(rows[6][1].split())) + " password: abcdefgh12345678", "aa", "s2")]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == docs.columns, name
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        sizes.append({r.doc_id for r in out.select("doc_id").collect()})
    assert not sizes[0] & {501, 502} and 500 in sizes[0]
    assert 500 not in sizes[1] and 503 not in sizes[2] and sizes[3] == sizes[2]
    assert out.where("doc_id = 504").first().text.endswith("[secret]")
    wanted = {r.doc_id: bpe._tokenizer(bpe.VOCABULARY).encode(r.text, add_special_tokens=False).ids for r in out.collect()}
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == wanted


def test_queries_and_sql_have_the_same_names():
    from pavelake.llm import queries

    assert queries.oracles().keys() <= queries.registered().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registered()) == list(range(1, 14))
