"""Fill-in-the-middle, license rules and the Merkle manifest against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.llm import infill, licenses, merkle, queries
from salescope.llm.license_rules import RULES, TIERS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place long, node string, path string, grp string, h0 long, output string, found string"
CLASH = (7, "n", "p", "g", 3, "o", "f")


def texts():
    rng = random.Random(5)
    alphabet = "abc é漢😀́\n<PSM>"
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    lines = ["under the MIT license", "Licensed under the Apache License, Version 2.0.", "CC BY-NC-SA 4.0", "SPDX-License-Identifier: GPL-3.0-or-later",
             "GNU Lesser General Public License v2.1", "All rights reserved", "Permission is hereby granted, free of charge, to any person obtaining a copy"]
    out = [make(n) for n in (1, 2, 3, 7, 8, 9, 64, 700)] + ["<P>", "a<S>", "<<M>", "😀", "漢" * 5, "é" * 17]
    out += lines + [". ".join(rng.choices(lines, k=40)), "mit " * 50, "under the mit license " * 300, None, "", "  \n", out[7], out[7], "x" * 100_000 + "😀漢" * 9]
    return out


@pytest.fixture(scope="module")
def rows():
    held = [(i, t, ["en", "fr", None, "en", "en"][i % 5], "s" if i % 4 else None, i if i % 3 else None, *CLASH) for i, t in enumerate(texts())]
    return held + [held[3], held[3], (None, "no id", "en", "s", 5, *CLASH), (None, None, None, None, None, *CLASH), (90, "alone", "zu", "s", 1, *CLASH)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_units_are_code_points():
    text = "".join(texts()[:14])
    data = np.frombuffer(text.encode(), np.uint8)
    units = infill.Units(data)
    ends = np.cumsum([len(c.encode()) for c in text])
    assert units.select(np.arange(1, len(text) + 1)).tolist() == ends.tolist()
    assert units.rank(np.append(0, ends)).tolist() == list(range(len(text) + 1))


def test_infill(spark, docs, rows):
    def expected(doc_id, text):
        text, digest = text or "", sha(f"1:{'' if doc_id is None else doc_id}")
        h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
        n = len(text)
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        if not text or any(m in text for m in infill.MARKS) or h[2] % 100 >= 90:
            return n, "plain", None, None, text
        p, m, s = text[:a], text[a:b], text[b:]
        spm = h[3] % 100 < 20
        return n, "spm" if spm else "psm", a, b - a, f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"

    got = infill.transform(docs).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    want = Counter(((d[0], *expected(d[0], d[1])), d[1] or "") for d in rows)
    assert Counter((tuple(r[:6]), r["back"]) for r in got) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert infill.transform(docs.limit(0)).count() == 0


def test_infill_stretches_and_wide_texts(spark, docs, monkeypatch):
    whole = Counter(map(tuple, infill.transform(docs).collect()))
    monkeypatch.setattr(infill, "STRETCH", 100)
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        assert Counter(map(tuple, infill.transform(docs).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")
    for marks in (("<a", "a>", "b"), ("ab", "abc", "x"), ("", "a", "b"), ("a", "a", "b")):
        with pytest.raises(ValueError):
            infill.check_marks(marks)


def brute_detections(text):
    words = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).split(" ")
    words = [w for w in words if w]
    line = " " + " ".join(words) + " "
    found = []
    for i, rule in enumerate(RULES):  # every rule on every text, no gate
        for m in re.finditer(f" (?:{rule.expression})(?= )", line):
            first = line[: m.start()].count(" ")
            found.append((list(TIERS).index(rule.tier), -(m[0].count(" ") - 1), first, i, first + m[0].count(" ") - 1))
    kept = []
    for tier, _, first, i, last in sorted(found):
        within = any(a <= first and last <= b for _, a, b, _ in kept)
        holds = any(first <= a and b <= last for t, a, b, _ in kept if t > 0)
        if not within and (tier == 0 or not holds):
            kept.append((tier, first, last, RULES[i].label))
    return len(words), sorted((a, b, label, list(TIERS)[t]) for t, a, b, label in kept)


def test_licenses(spark, docs, rows):
    got = {(r["doc_id"], r["n_words"], tuple((d["first"], d["last"], d["label"], d["tier"]) for d in r["found"])) for r in licenses.detect(docs).collect()}
    assert got == {(d[0], n, tuple(found)) for d in rows for n, found in [brute_detections(d[1])]}
    assert licenses.detect(docs.limit(0)).count() == 0


def labels(text):
    return {label for *_, label, _ in brute_detections(text)[1]}


def test_license_labels():
    assert labels("Dual: SPDX-License-Identifier: MPL-2.0, see https://www.gnu.org/licenses/old-licenses/gpl-2.0.html") == {"mpl-2", "gpl-2"}
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-3"}
    assert labels("under the GNU Lesser General Public License version 2.1") == {"lgpl-2.1"}
    assert labels("available under CC BY-NC-SA 4.0") == {"cc-by-nc", "cc-by-nc-sa"}
    assert labels("the mit of commit, an apache helicopter, general remarks on the public and license to kill") == set()


def test_keys_are_part_of_their_expressions():
    assert len(RULES) > 250
    for rule in RULES:
        words = set(re.findall(r"[a-z0-9]+", re.sub(r"\[[^\]]*\]|\?", "", rule.expression)))
        assert set(rule.keys) <= words, rule


def h(*parts):
    return sha("".join(parts))


def brute_trees(leaves, fanout):
    """Root and the siblings (before, after) of each leaf, level by level."""
    nodes, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for j, i in enumerate(at):
            run = i - i % fanout
            paths[j].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + fanout])))
            at[j] = i // fanout
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute_manifest(rows, fanout):
    """rows (key, group, leaf) -> sorted (key, leaf, subroot, root, path)."""
    groups = {}
    for key, group, leaf in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(group, []).append((key, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_trees([leaf for _, leaf in groups[g]], fanout) for g in names}
    root, above = brute_trees([trees[g][0] for g in names], fanout)
    return Counter((key, leaf, trees[g][0], root, tuple(path + above[j]))
                   for j, g in enumerate(names) for (key, leaf), path in zip(groups[g], trees[g][1]))


def leaf_of(row):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*[field(row[i]) for i in (0, 3, 2, 4, 1)])


def test_manifest(spark, docs, rows, monkeypatch):
    leaves = docs.withColumn("leaf", merkle.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]))
    for fanout, block in ((2, 1024), (3, 9), (2, 4)):
        monkeypatch.setattr(merkle, "BLOCK", block)
        got = merkle.manifest(leaves.select("doc_id", "lang", "leaf"), "doc_id", "lang", fanout).collect()
        found = Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["before"], s["after"]) for s in r["path"])) for r in got)
        assert found == brute_manifest([(d[0], d[2], leaf_of(d)) for d in rows], fanout)
    assert merkle.manifest(leaves.limit(0).select("doc_id", "lang", "leaf"), "doc_id", "lang").count() == 0
    held = merkle.manifest(leaves.drop("place", "path"), "doc_id", "lang").first()
    assert (held["node"], held["grp"]) == ("n", "g")  # other columns keep their values
    one = merkle.manifest(leaves.where("doc_id = 90").select("doc_id", "lang", "leaf"), "doc_id", "lang").collect()
    assert [(r["leaf"], r["path"]) for r in one] == [(one[0]["root"], [])]


def test_manifest_shows_each_change(spark, docs):
    leaves = docs.select("doc_id", "lang", merkle.leaf(F.col("doc_id"), F.col("text")).alias("leaf"))
    found = merkle.manifest(leaves, "doc_id", "lang")
    assert found.where(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert found.where(merkle.folded(F.sha2("leaf", 256), F.col("path")) == F.col("root")).count() == 0


def test_queries_on_odd_tables(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("op11_swar_infill", "op12_license_rules", "op13_lag_lead_merkle"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == len(rows)
        assert queries.QUERIES[name](spark, f"{tmp_path}/none").count() == 0


def test_stretches_of_lone_anchors_are_not_hashed(monkeypatch):
    import numpy as np
    import pandas as pd

    from salescope.llm import columnwise

    rng = np.random.default_rng(5)
    lone = "".join(map(chr, rng.integers(97, 123, 3000)))
    hashed, contents = [], columnwise.Stretches._contents
    monkeypatch.setattr(columnwise.Stretches, "_contents", lambda self, base, *of: hashed.append(len(of[-1])) or contents(self, base, *of))
    one = columnwise.Stretches(pd.DataFrame({"text": [lone]}), 100)
    assert one.first_copies(np.arange(1), 100).all() and not any(hashed)
    two = columnwise.Stretches(pd.DataFrame({"text": [lone[:400], lone]}), 100)
    first = two.first_copies(np.array([1, 0]), 100)  # the second row comes first
    # the last stretch of the short text may end before its twin does, and is then no copy
    assert first[two.row == 1].all() and first[two.row == 0].sum() <= 1 and max(hashed) < len(two.row)


def test_a_large_cache_of_pieces_goes_with_its_task(monkeypatch):
    import public_tokenizers

    from salescope.llm import encode

    one = encode.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    before = list(one.encode(["one two three four"]))
    monkeypatch.setattr(encode, "KEPT_ENTRIES", 4)
    one.rest()
    assert len(one.cache) == 4  # a small one stays
    list(one.encode(["five"]))
    one.rest()
    assert not one.cache and list(one.encode(["one two three four"])) == before


def test_what_leaves_a_block_goes_in_few_frames():
    from salescope.llm import columnwise

    names = ["part", "bucket", "ids", "bytes"]
    records = [(0, i, b"12345678", b"x" * 1000) for i in range(5000)]
    found = list(columnwise.frames(iter(records), names))
    assert len(found) == 2 and [tuple(r) for f in found for r in f.itertuples(index=False)] == records
    assert not list(columnwise.frames(iter([]), names))
    large = [(0, i, b"", b"x" * columnwise.FRAME_BYTES) for i in range(3)]
    assert [len(f) for f in columnwise.frames(iter([*large, (0, 3, b"1", None)]), names)] == [1, 1, 1, 1]


def test_pieces_met_most_often_stay_after_a_task(monkeypatch):
    import public_tokenizers

    from salescope.llm import encode

    one = encode.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(encode, "KEPT_ENTRIES", 2)
    for text in ("one two three four", "one two three", "one three"):
        before = list(one.encode([text]))
    one.rest()
    assert set(one.cache) == {"one", " three"} and list(one.encode(["one three"])) == before
    list(one.encode(["five six seven"]))
    one.rest()
    assert set(one.cache) == {"one", " three"}
