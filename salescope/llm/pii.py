"""Personal data: fixed patterns, and contexts learned from what they find (bootstrapping).

1. The fixed patterns find the seeds of each kind in whole texts, leftmost and without overlap for a kind.
2. Each seed, and each other string of an identifier's loose shape (a slot), has a lexical pattern: the two words or marks before it.
   Patterns and strings form a graph.
3. Spark scores the graph in rounds. A pattern's confidence for a kind is the score of the distinct strings it holds over their
   number; it counts from ``MIN_SEEDS`` distinct known strings on. A string's score is 1 for a seed, else 1 less the product of
   (1 - confidence) over its patterns. Strings of high score are known in the next round.
4. Slots under a pattern of high confidence, and further places of strings that were accepted, are added, unless they overlap a
   fixed match.

Null and empty texts have no spans. Equal rows have equal spans; a string or pattern counts once however often it is repeated, so
copies don't make a pattern surer. Without seeds nothing is added. Places count code points; columns but doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS, MIN_SEEDS, CONFIDENT, ACCEPTED = 3, 3, 0.8, 0.8
LOCAL = r"[A-Za-z0-9._%+-]"
#: The kinds' patterns; starting only at the beginning of a run finds the same matches without going over a long run again and again.
AT = re.compile(rf"{LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL = re.compile(rf"(?<!{LOCAL}){AT.pattern}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Shapes of strings that may be an identifier which the fixed patterns don't know.
SLOTS = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}+(?: ?[\[(]at[\])] ?|@)[\w.-]{2,255}"),
    "ip": re.compile(r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){3,7}[0-9a-fA-F]{1,4}(?![\w:])"),
    "card": re.compile(r"(?<![\w+-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\w-])"),
    "phone": re.compile(r"(?<![\w+.-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}(?![\w-])"),
}
TOKEN = re.compile(r"\w+|[^\w\s]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[re.Match]:
    end = -1
    found = EMAIL.search(text) if "@" in text else None
    while found:
        yield found
        end = found.end()
        found = AT.match(text, end) or EMAIL.search(text, end)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start and then kind."""
    out = [("email", m.start(), m.end()) for m in _emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def context(text: str, start: int) -> str | None:
    """The two words or marks before a place; none without a letter."""
    tokens = TOKEN.findall(text[max(0, start - 60) : start].lower())[-2:]
    return " ".join(tokens) if any(c.isalpha() for t in tokens for c in t) else None


def slots(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Strings of a loose shape that no fixed match overlaps."""
    out = []
    for kind, shape in SLOTS.items():
        if kind == "email" and "@" not in text and "at" not in text:
            continue
        for m in shape.finditer(text):
            if not any(m.start() < b and a < m.end() for _, a, b in [*taken, *out]):
                out.append((kind, m.start(), m.end()))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """row, doc_id, base spans, and mentions: each fixed match and slot with its context."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "kind string, start int, end int"
    schema = f"row long, doc_id {kind}, base array<struct<{span}>>, mentions array<struct<{span}, pattern string, value string, seed boolean>>"

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, mentions = [], []
            for text in batch["text"]:
                known = base_spans(text) if text else []
                more = slots(text, known) if text else []
                base.append([dict(zip(("kind", "start", "end"), s)) for s in known])
                mentions.append([{"kind": k, "start": a, "end": b, "pattern": context(text, a), "value": text[a:b].lower(), "seed": seed}
                                 for seed, spans in ((True, known), (False, more)) for k, a, b in spans])
            yield pd.DataFrame({"row": batch["row"], "doc_id": batch["doc_id"], "base": base, "mentions": mentions})

    return rows.mapInPandas(find, schema)


def learned(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patterns (kind, pattern, confidence) and strings (kind, value, score) after the rounds."""
    edges = mentions.where("pattern is not null").groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed"))
    edges = stored(edges, "pattern-graph")
    # a string may stand under a pattern as different kinds; all of them count as held by the pattern
    held = stored(edges.select("pattern", "value").distinct().groupBy("pattern").agg(F.count("*").alias("held")), "pattern-sizes")
    score = edges.groupBy("kind", "value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    patterns = None
    for _ in range(ROUNDS):
        known = edges.join(score, ["kind", "value"]).groupBy("kind", "pattern").agg(
            F.sum("score").alias("sum"), F.sum((F.col("score") >= ACCEPTED).cast("int")).alias("known"))
        patterns = stored(known.join(held, "pattern").where(F.col("known") >= MIN_SEEDS).select(
            "kind", "pattern", (F.col("sum") / F.col("held")).alias("confidence")), "patterns")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.coalesce("confidence", F.lit(0.0)), F.lit(1e-9)))))
        score = stored(edges.join(patterns, ["kind", "pattern"], "left").groupBy("kind", "value").agg(
            F.greatest(F.max(F.col("seed").cast("double")), 1 - doubt).alias("score")), "strings")
    return patterns, score


def find_personal_data(docs: DataFrame) -> DataFrame:
    """row, doc_id, base and added: arrays of (kind, start, end)."""
    scanned = stored(scan(docs), "scanned")
    mentions = scanned.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    patterns, strings = learned(mentions)
    sure = patterns.where(F.col("confidence") >= CONFIDENT).select("kind", "pattern", F.lit(True).alias("by_pattern"))
    accepted = strings.where(F.col("score") >= ACCEPTED).select("kind", "value", F.lit(True).alias("by_value"))
    added = mentions.where("not seed").join(sure, ["kind", "pattern"], "left").join(accepted, ["kind", "value"], "left")
    added = added.where("by_pattern or by_value").groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    return scanned.join(added, "row", "left").select(
        "row", "doc_id", "base", F.coalesce("added", F.array().cast(scanned.schema["base"].dataType)).alias("added"))


def ordered(spans) -> Column:
    """Spans by start and then kind."""
    rank = F.create_map(*[F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def joined(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span in ``text`` replaced by its kind in brackets; overlapping spans become one, named by the first.

    Every other column stays as it is; ``n_chars``, if there is one, follows the text.
    """
    held = stored(docs.select(F.monotonically_increasing_id().alias("place"), F.struct("*").alias("row")), "before-redaction")
    found = find_personal_data(held.select(F.col("place").alias("doc_id"), F.col("row.text").alias("text")))
    found = found.where("size(base) + size(added) > 0").select(F.col("doc_id").alias("place"), ordered(F.concat("base", "added")).alias("spans"))

    @F.pandas_udf("string")
    def hide(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans):
            parts, at = [], 0
            for s in found if found is not None and text else ():
                if s["start"] >= at:
                    parts += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
                at = max(at, s["end"])
            out.append(text if not parts else "".join(parts) + text[at:])
        return pd.Series(out, dtype=object)

    row, clean = F.col("row"), F.col("spans").isNull()
    columns = {c: row[c] for c in docs.columns}
    columns["text"] = F.when(clean, row["text"]).otherwise(hide(row["text"], F.col("spans")))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(clean, row["n_chars"]).otherwise(F.length(columns["text"])).cast(docs.schema["n_chars"].dataType)
    return held.join(found, "place", "left").select(*[column.alias(c) for c, column in columns.items()])
