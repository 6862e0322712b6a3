"""Each corpus operator against brute force, with nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from salescope.llm import columnwise, common, components, katz, language, lookup, packing, pieces, pii, simhash, subspaces, token_streams, windows, winnowing
from salescope.llm.ragged import mix
from salescope.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, block string, base string, key string, bucket int, part int"
ITEMS = "item_id string, text string, score double"


def texts():
    rng = random.Random(3)
    stock = ["the", "And", "of", "rain,", "über", "maison.", "ñandú", "tree", "Stone", "x1", "river"] + [f"w{i}" for i in range(60)]
    make = lambda n: " ".join(rng.choice(stock) for _ in range(n))
    shared = make(60)
    out = [make(n) for n in (1, 2, 3, 9, 36, 120, 700)]
    out += [make(30) + " " + shared + " " + make(20), shared, make(5) + "\n" + shared, out[5], out[5], out[5] + " end"]
    out += [None, "", "   \n", "mail a.b@c.example.org or +1 (212) 555-0199, card 4539 1488 0343 6467 ip 10.0.0.1 and 300.1.1.1", "9 9 9 !!", "long " * 3000]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], "s", 1, 0.5, "b", "x", "k", 1, 2) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def stable(spark, docs):
    path = scratch_path(spark, "docs")
    docs.write.parquet(path)
    return spark.read.parquet(path)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_streams(spark, docs):
    vocabulary, folder = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "streams")
    index = token_streams.write_streams(docs, vocabulary, folder, 2, length=64, rows=4)
    got = by_id(token_streams.read_checksums(token_streams.with_starts(index), folder))
    library, start = Tokenizer.from_file(vocabulary), 0
    for i, text in enumerate(texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    name = got[18]["file"]
    file = token_streams.SequenceFile(f"{folder}/{name}")
    ids, mask = file[len(file) - 1]
    assert len(ids) == len(mask) == 64 and sum(file[i][1].sum() for i in range(len(file))) == sum(r["n_tokens"] for r in got.values() if r["file"] == name)
    assert token_streams.write_streams(empty(spark), vocabulary, scratch_path(spark, "none"), 2).count() == 0


def test_packing(spark, docs):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(pieces.encoded_pieces(docs.union(docs), vocabulary, 512, 1), "length", 512, ["doc_id", "piece"]).collect()
    library, want = Tokenizer.from_file(vocabulary), Counter()
    for i, text in enumerate(texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.update({(i, k, at, len(ids[at : at + 512]), crc(ids[at : at + 512])): 2 for k, at in enumerate(range(0, len(ids), 512))})
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    rooms: list[int] = []
    for n in sorted((r["length"] for r in rows), reverse=True):  # first fit by falling length
        at = next((i for i, room in enumerate(rooms) if room >= n), None)
        if at is None:
            rooms.append(512 - n)
        else:
            rooms[at] -= n
    assert len(sequences) <= len(rooms)
    assert packing.pack(pieces.encoded_pieces(empty(spark), vocabulary, 512, 1), "length", 512, ["doc_id"]).count() == 0


def test_plan_places_every_rank_once():
    rng = random.Random(1)
    for _ in range(20):
        lengths = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(rng.randint(1, 30))}
        placed, n = packing.plan(lengths, 100)
        room, ranks = defaultdict(list), defaultdict(list)
        for length, low, high, first, offset in placed:
            ranks[length] += range(low, high)
            for k in range(high - low):
                room[first + k].append((offset, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in lengths.items()}
        for places in room.values():
            assert [o for o, _ in sorted(places)] == [0, *np.cumsum([w for _, w in sorted(places)]).tolist()][:-1]
            assert sum(w for _, w in places) <= 100
        assert len(room) <= 1.15 * sum(k * v for k, v in lengths.items()) / 100 + 25


def simhash_of(text, n):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def wide_simhash_of(text, n, words):
    """Bits of each word by brute force, in the order of its bytes, highest bit of a byte first."""
    w = (text or "").encode().lower().split()
    h = np.array([xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))], np.uint64)
    out = []
    for j in range(words):
        values = [int(x) for x in (mix(h + np.uint64(j)) if j else h)]
        bits = [2 * sum(x >> b & 1 for x in values) > len(values) for b in range(64)]
        out += [bits[8 * byte + 7 - b] for byte in range(8) for b in range(8)]
    return out


def agree_widely(a, b):
    same = [x == y for x, y in zip(a, b)]
    return any(all(same[i : i + 12]) for i in range(0, len(same) - 11, 12)) and sum(same) >= 0.8 * len(same)


def least_reachable(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_simhash(spark, docs):
    got, marks = by_id(simhash.near_duplicates(docs, 3)), [simhash_of(t, 3) for t in texts()]
    links = [(a, b) for a in range(len(marks)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 3]
    label = least_reachable(len(marks), links)
    assert {i: (r["fp"] % (1 << 64), r["component_id"]) for i, r in got.items()} == {i: (marks[i], label[i]) for i in range(len(marks))}
    assert simhash.near_duplicates(empty(spark), 3).count() == 0


def test_simhash_splits_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 8)
    rng = random.Random(5)
    marks = sorted({rng.getrandbits(14) for _ in range(300)} | {rng.getrandbits(63) for _ in range(50)})
    links = simhash.near_links(spark.createDataFrame([(m,) for m in marks], "fp long"), 3)
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    label = least_reachable(len(marks), [(a, b) for a in range(len(marks)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 3])
    assert [roots.get(m, m) for m in marks] == [marks[i] for i in label]


def test_simhash_bands_link_copies_of_lower_similarity(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    rng = random.Random(9)
    bodies = [None, "", "one two"]
    for _ in range(6):
        words = [f"w{rng.randrange(500)}" for _ in range(120)]
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(500)}"
            bodies.append(" ".join(copy))
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(bodies)], "doc_id long, text string, wide string, bucket int")
    marks, wide = [simhash_of(t, 5) for t in bodies], [wide_simhash_of(t, 5, 5) if t else [False] * 320 for t in bodies]
    links = [(a, b) for a in range(len(bodies)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 6 or agree_widely(wide[a], wide[b])]
    label = least_reachable(len(bodies), links)
    got = by_id(simhash.near_duplicates(rows, 5, 6, 8, 5, 0.8))
    assert {i: r["component_id"] for i, r in got.items()} == dict(enumerate(label))
    assert len(links) > sum((marks[a] ^ marks[b]).bit_count() <= 6 for a in range(len(bodies)) for b in range(a))
    shingles = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} if t else set() for t in bodies]
    close = [(a, b) for a in range(3, len(bodies)) for b in range(3, a) if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])]
    assert len(close) > 50 and all(label[a] == label[b] for a, b in close)
    assert simhash.near_duplicates(rows.limit(0), 5, 6, 8, 5, 0.8).count() == 0


def shingle_set(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def alike(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b) > 0


def test_near_copies_are_verified_on_their_shingles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    rng = random.Random(4)
    bodies = [None, "", " ", "one two", "One two", "one two three", "go " * 9000]
    for changed in (0, 2, 4, 5, 6, 8, 10, 14):  # similarity from 1 down to 0.5 around a common template
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        for _ in range(12):
            copy = list(words)
            for i in range(changed):
                copy[(i * 200 // max(changed, 1) + rng.randrange(3)) % 200] = f"x{rng.randrange(10**9)}"
            bodies.append(" ".join(copy))
    bodies += ["go " * 500 + bodies[-1], "go " * 500 + bodies[10]]  # a repeated shingle is one
    sets = [shingle_set(t, 5) for t in bodies]
    close = [(a, b) for a in range(len(sets)) for b in range(a) if alike(sets[a], sets[b])]
    label = least_reachable(len(bodies), close)
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(bodies)], "doc_id long, text string, wide string, node int")
    got = by_id(simhash.similar_documents(rows, 5, 6, 0.75, 0.8))
    assert {i: r["component_id"] for i, r in got.items()} == dict(enumerate(label))
    assert len(set(label)) > 40  # of 84 near copies, most are below 0.8


def test_similar_sets_connect():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 12, rng.integers(0, 12)).astype(np.uint64)) for _ in range(60)]
    plain = [set(s.tolist()) for s in sets]
    want = least_reachable(60, [(a, b) for a in range(60) for b in range(a) if alike(plain[a], plain[b])])
    assert simhash.similar(sets, 0.8).tolist() == want


def test_language(spark):
    rng = random.Random(2)
    words = {"en": ["the", "house", "white", "through"], "de": ["straße", "und", "größe", "nicht"], "fr": ["où", "maison", "garçon", "très"]}
    rows = [(i, " ".join(rng.choices(words[k], k=20)), k) for i, k in enumerate(list(words) * 20)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tests = [(0, "the white house", ""), (1, "straße und größe", ""), (2, None, ""), (3, "12 !?", ""), (4, "", ""), (5, "the house " * 30 + "où garçon très " * 10, ""), (5, "the white house", "")]
    asked = spark.createDataFrame(tests, "doc_id long, text string, lang_x string")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(asked, train).collect()]
    assert [(a, b) for a, b, _ in got] == [(0, "en"), (1, "de"), (2, "und"), (3, "und"), (4, "und"), (5, "en"), (5, "en")]
    assert 0.4 < got[5][2] < 0.95 and all(0 <= s <= 1 for *_, s in got)
    assert {r["lang_pred"] for r in language.identify(asked, train.limit(0)).collect()} == {"und"}


def hits(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: word.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
    out = {}
    for i, text in enumerate(docs):
        w, gone, found = lower(text), set(), set()
        for item, body in items:
            b = lower(body)
            n = min(10, len(b))
            runs = {tuple(b[j : j + n]) for j in range(len(b) - n + 1)} if b else set()
            for j in range(len(w) - n + 1 if b else 0):
                if tuple(w[j : j + n]) in runs:
                    gone.update(range(j, j + n))
                    found.add(item)
        out[i] = (len(w), len(gone), sorted(found))
    return out


def test_winnowing(spark, docs):
    body = texts()
    items = [("a", body[8][:150]), ("b", body[5]), ("c", "x1 river"), ("d", None), ("e", ""), ("f", body[6][100:400].upper()), ("b", body[5])]
    got = by_id(winnowing.contamination(docs, spark.createDataFrame([(*x, 0.0) for x in items], ITEMS)).select("doc_id", "n_words", "n_hit", "item_ids"))
    assert {i: (r["n_words"], r["n_hit"], r["item_ids"]) for i, r in got.items()} == hits(body, items)
    assert winnowing.contamination(docs, spark.createDataFrame([], ITEMS)).where("contaminated").count() == 0
    assert winnowing.contamination(empty(spark), spark.createDataFrame([("a", "b", 0.0)], ITEMS)).count() == 0


def test_winnowing_counts_items_without_an_id(spark, docs):
    body = texts()
    items = spark.createDataFrame([(None, body[5], 0.0), (None, "x1 river", 0.0), ("a", body[6][:200], 0.0), ("b", body[5], 0.0)], ITEMS)
    none = items.where("item_id is null")
    got, plain = by_id(winnowing.contamination(docs, none)), hits(body, [("n", body[5]), ("n", "x1 river")])
    assert {i: (r["n_hit"], r["item_ids"], r["contaminated"]) for i, r in got.items()} == {i: (h, [], bool(ids)) for i, (_, h, ids) in plain.items()}
    got, plain = by_id(winnowing.contamination(docs, items)), hits(body, [("n", body[5]), ("n", "x1 river"), ("a", body[6][:200]), ("b", body[5])])
    assert {i: (r["n_hit"], r["item_ids"]) for i, r in got.items()} == {i: (h, [x for x in ids if x != "n"]) for i, (_, h, ids) in plain.items()}
    assert got[5]["contaminated"]


def test_katz_adds_up_to_one_and_matches(spark, stable):
    train = F.col("doc_id") % 5 != 1
    got = by_id(katz.score(stable.withColumn("train", train)))
    tokens = [(t or "").encode().lower().split() + [None] for t in texts()]
    single, double = Counter(), Counter()
    for i, w in enumerate(tokens):
        if i % 5 != 1:
            single.update(w)
            double.update(zip(["<s>", *w], w))
    d1, d2 = (katz.Discount([sum(v == k for v in c.values()) for k in range(1, 7)]) for c in (single, double))
    n = sum(single.values())
    alone = {w: float(d1(np.array(v))) / n for w, v in single.items()}
    unknown = 1 - sum(alone.values())
    after = defaultdict(dict)
    for (p, w), v in double.items():
        after[p][w] = v

    def chance(p, w):
        if p not in after:
            return alone.get(w, unknown)
        total = sum(after[p].values())
        seen = {x: float(d2(np.array(v))) / total for x, v in after[p].items()}
        mass = sum(seen.values())
        scale = total / (total + 1) / mass if mass > 1 - 1e-9 else 1
        if w in seen:
            return seen[w] * scale
        return (1 - mass * scale) / (1 - sum(alone[x] for x in seen)) * alone.get(w, unknown)

    for p in ["<s>", b"w1", b"long"]:
        assert sum(chance(p, w) for w in [*single, "unknown"]) == pytest.approx(1)
    for i, w in enumerate(tokens):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(single[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((single[x] + 0.5) / (n + 0.5 * (len(single) + 1))) for x in w))
        assert r["score"] == pytest.approx(sum(np.log10(chance(p, x)) for p, x in zip(["<s>", *w], w)))
    assert katz.score(empty(spark).withColumn("train", F.lit(True))).count() == 0


def test_katz_sends_one_frame_a_block_and_sorts_no_contexts(monkeypatch):
    rows = pd.DataFrame({"text": ["b a b c", None, "", "a", "c c b a b"], "train": True})
    tokens = katz.Tokens(rows)
    sent = tokens.sent(16)
    monkeypatch.setattr(lookup, "sent", None)
    out = tokens.contexts(sent[1])
    assert sorted(out.order) == list(range(len(tokens.token)))
    groups = np.split(tokens.context[out.order], out.places[1:])
    assert all((g == g[0]).all() for g in groups) and len({int(g[0]) for g in groups}) == len(groups) == 4  # a, b, c, start
    assert {int(g[0]): len(g) for g in groups} == Counter(tokens.context.tolist())
    keys = tokens.context[out.order[out.places]]
    frame = katz._messages(out, block=3, keys=katz._blobs(out, keys), counts=katz._blobs(out, out.counts(), narrow=True))
    assert len(frame) == len(out.parts) > 1 and frame["n"].tolist() == [len(own) for _, own in out.parts]
    assert [np.frombuffer(k, np.uint64).tolist() for k in frame["keys"]] == [tokens.context[own].tolist() for _, own in out.parts]
    assert katz._wide(frame["counts"], frame["n"]).tolist() == out.counts().tolist()


def test_subspaces(spark, monkeypatch):
    monkeypatch.setattr(subspaces, "CHUNK_ROWS", 16)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 32))
    vectors = [(centres[i % 6] + rng.standard_normal(32) * 0.2).tolist() for i in range(90)]
    vectors += [vectors[0], vectors[0], (np.array(vectors[1]) * 7).tolist(), [0.0] * 32, [float("nan")] * 32, [None] * 32, None, [], [1.0, 2.0], [2.0, 4.0]]
    rows = spark.createDataFrame([(i, v, 1, 2.0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int, vector double")
    good = lambda v: bool(v) and None not in v and np.isfinite(v).all() and any(v)
    links = []
    for a, v in enumerate(vectors):
        for b, w in enumerate(vectors[:a]):
            if good(v) and good(w) and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.95:
                links.append((a, b))
    label, count = least_reachable(len(vectors), links), Counter(x for pair in links for x in pair)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in subspaces.near_vectors(rows, 0.95).collect()}
    assert len(links) > 100 and got == {i: (count[i], label[i], label[i] == i) for i in range(len(vectors))}
    assert subspaces.near_vectors(rows.limit(0), 0.95).count() == 0


def test_subspaces_store_each_vector_once_however_many_tiles(spark, monkeypatch, tmp_path):
    import pyarrow.dataset

    folders = iter(range(10**6))
    for module in (subspaces, common):
        monkeypatch.setattr(module, "scratch_path", lambda _, name: str(tmp_path / f"{name}-{next(folders)}"))
    monkeypatch.setattr(subspaces, "CHUNK_ROWS", 8)
    rng = np.random.default_rng(6)
    vectors = (rng.standard_normal((5, 24))[np.arange(120) % 5] + rng.standard_normal((120, 24)) * 0.15).astype("f4").tolist()
    vectors += [vectors[0], [-0.0, *[1.0] * 23], [0.0, *[1.0] * 23], [3.0, 4.0], [6.0, 8.0], None]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in subspaces.near_vectors(rows, 0.95).collect()}
    unit = [np.array(v or []) / np.linalg.norm(v or [1]) for v in vectors]
    links = [sum(i != j and len(u) == len(v) > 0 and u @ v >= 0.95 for j, v in enumerate(unit)) for i, u in enumerate(unit)]
    assert got == dict(enumerate(links)) and sum(links) > 1000
    tables = [pyarrow.dataset.dataset(str(f)) for f in tmp_path.iterdir() if any(f.rglob("*.parquet"))]
    assert sum(t.count_rows() for t in tables if "vector" in t.schema.names) == 123  # the distinct ones


def test_columnwise(spark, stable):
    got, seen = by_id(columnwise.removed_bytes(stable, 100)), set()
    for i, text in enumerate(texts()):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - 99):
            gone[at : at + 100] |= raw[at : at + 100] in seen
            seen.add(raw[at : at + 100])
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(raw), gone.sum(), spans, hashlib.sha256(kept).hexdigest()), i
    assert columnwise.removed_bytes(empty(spark), 100).count() == 0


def test_columnwise_spreads_a_hot_phrase(spark, monkeypatch):
    rng, real = random.Random(8), columnwise.repeats

    def repeats(table, length, columns):
        if len(table) > 20:
            raise AssertionError(f"{len(table)} stretches in one table")
        return real(table, length, columns)

    monkeypatch.setattr(columnwise, "HOT", 10)
    monkeypatch.setattr(columnwise, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(columnwise, "repeats", repeats)
    word = lambda n: "".join(rng.choice("abcdefgh ü") for _ in range(n))
    hot, tails = word(60), [word(80) for _ in range(3)]
    bodies = [word(150) + hot + (rng.choice(tails) if i % 2 else "") + word(100) for i in range(90)]
    path = scratch_path(spark, "hot")
    spark.createDataFrame([(i, t) for i, t in enumerate(bodies)], "doc_id long, text string").repartition(3, "doc_id").write.parquet(path)
    got, seen = by_id(columnwise.removed_bytes(spark.read.parquet(path), 100)), set()
    for i, text in enumerate(bodies):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - 99):
            gone[at : at + 100] |= raw[at : at + 100] in seen
            seen.add(raw[at : at + 100])
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (gone.sum(), hashlib.sha256(kept).hexdigest()), i
    assert sum(r["n_removed"] > 0 for r in got.values()) > 20


def test_personal_data(spark, docs):
    got = by_id(pii.find_personal_data(docs))
    text = texts()[16]
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in got[16]["base"]] == [
        ("email", "a.b@c.example.org"), ("phone", "+1 (212) 555-0199"), ("card", "4539 1488 0343 6467"), ("ip", "10.0.0.1")]
    assert sum(len(r["base"]) for r in got.values()) == 4 and pii.find_personal_data(empty(spark)).count() == 0
    assert pii.base_spans("a@b.c%d@e.f " + "1" * 5000 + "." + "x" * 20000)[:2] == [("email", 0, 5), ("email", 5, 11)]
    clean = by_id(pii.redact(docs))
    assert clean[16]["text"] == "mail [EMAIL] or [PHONE], card [CARD] ip [IP] and 300.1.1.1" and clean[16]["n_chars"] == len(clean[16]["text"])
    assert clean[13]["text"] is None and clean[14]["text"] == "" and clean[5]["text"] == texts()[5]


def test_contexts_find_unseen_identifiers(spark):
    known = [(i, f"please call me at +1 (212) 555-01{i:02d} today", 0) for i in range(12)]
    more = [(50, "please call me at 212-555-0177 today", 0), (51, "lot number 2125550188 was sold", 0), (52, "write 212-555-0177 down", 0)]
    found = by_id(pii.find_personal_data(spark.createDataFrame(known + more, "doc_id long, text string, pattern int")))
    assert [(s["kind"], s["start"], s["end"]) for s in found[50]["added"]] == [("phone", 18, 30)]
    assert found[51]["added"] == [] and len(found[52]["added"]) == 1


def test_windows(spark, docs):
    got, count = by_id(windows.removed_words(docs, 35)), Counter()
    words = [(t or "").encode().split() for t in texts()]
    for w in words:
        count.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    for i, w in enumerate(words):
        gone = {j for k in range(len(w) - 34) if count[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone), hashlib.sha256(kept).hexdigest()), i
    assert windows.removed_words(empty(spark), 35).count() == 0


def test_blocks_spread_rows_of_one_id(spark):
    rows = spark.createDataFrame([(None, "same words " * 20)] * 200 + [(7, f"text {i} " * 20) for i in range(200)], "doc_id long, text string")
    for part in (rows, rows.where("doc_id is null"), rows.where("doc_id = 7")):
        dealt, total = lookup.blocks(part, 4000)
        count = -(-total // 4000)
        sizes = [r["n"] for r in dealt.groupBy("block").agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > count / 2 and max(sizes) < 10 * part.count() / count
    assert {r["n_removed"] for r in windows.removed_words(rows, 35).where("doc_id is null").collect()} == {40}


def test_pipeline_stages(spark, docs, tmp_path):
    extra = docs.withColumn("lang_pred", F.lit("x"))
    spark.createDataFrame([("a", texts()[6][:300], 0.0)], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language"](spark, extra, str(tmp_path))
    assert kept.columns == extra.columns and {r["doc_id"] for r in kept.collect()} == set(range(19)) - {13, 14, 15, 17}
    one = {r["doc_id"] for r in stages["near_copies"](spark, kept, str(tmp_path)).collect()}
    marks = {r["doc_id"]: simhash_of(r["text"], 3) for r in kept.collect()}
    ids = sorted(marks)
    label = least_reachable(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (marks[ids[a]] ^ marks[ids[b]]).bit_count() <= 3])
    assert one == {ids[i] for i, x in enumerate(label) if x == i} and 11 not in one
    assert {r["doc_id"] for r in stages["benchmark"](spark, extra, str(tmp_path)).collect()} == set(range(19)) - {6}
    assert stages["packing"](spark, kept.limit(0), str(tmp_path)).count() == 0
    for name in ("language", "near_copies", "benchmark", "personal_data"):
        assert stages[name](spark, extra.limit(0), str(tmp_path)).count() == 0


def test_pipeline_keeps_columns_of_clashing_names(spark, docs, tmp_path):
    """Every name the stages use for themselves may be a column of the documents, and keeps its values."""
    names = ["place", "row", "first", "missing", "component_id", "_row", "_place", "_spans", "spans", "_found", "lang_pred", "contaminated", "_key", "fp", "base", "found"]
    extra = docs.drop(*names).select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names])
    spark.createDataFrame([("a", texts()[6][:300], 0.0)], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == extra.columns, name
    rows = kept.collect()
    assert len(rows) > 5 and all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in names)


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library_with_special_strings_in_the_text(vocabulary):
    from salescope.llm.encode import Encoder

    path = public_tokenizers.path(vocabulary)
    library = Tokenizer.from_file(path)
    specials = [t.content for t in library.get_added_tokens_decoder().values()]
    assert specials and not any(c in " ,.\n" for s in specials for c in s)
    rng = random.Random(1)
    parts = [*specials, *specials, "word", " word", "  ", "\n", ", and", ".", "<|", "|>", "é漢", " a.b,c"]
    texts_ = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(300)] + specials
    got = [np.frombuffer(b, "<u4").tolist() for b in Encoder(path).encode(texts_)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts_]
