"""License scans by ordered signature rules.

A text becomes its words (runs of letters and digits, A-Z lower-cased) with one space between them. The text's distinct words gate the
rules: only rules whose key words are all among them run, so that most texts run none. Each match is a detection: a label, the tier
of its rule and the first and last word it covers. Detections are settled in order of tier, then length (longer first), place and rule:
one is dropped if its words lie within those of a detection that was kept before, or hold them all. Phrases, the first tier, all stay
and don't stand against longer names that hold them. So no kept name lies in another, and a binary search by first word decides each,
however many a text has. Detections that only overlap in part stay.

Ties: of two detections of the same words and tier the rule that comes first in the list stays. Null and empty texts have no words and no
detection. Equal rows have equal detections. A text of any length is matched whole; gaps inside expressions are bounded, so the
time is in proportion to the text. No rows give no rows; columns but doc_id and text are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from salescope.llm.license_rules import RULES, TIERS, Rule, compiled

#: A-Z become a-z, other ASCII but letters and digits a blank.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def text_words(text: str | None) -> list[bytes]:
    return text.encode().translate(WORDS).split() if text else []


class Kept:
    """Detections of which none lies within another, so that their first and their last words are in one order."""

    def __init__(self):
        self.firsts: list[int] = []
        self.rows: list[tuple[int, int, int]] = []

    def covers(self, first: int, last: int) -> bool:
        at = bisect_right(self.firsts, first) - 1
        return at >= 0 and self.rows[at][1] >= last

    def lies_in(self, first: int, last: int) -> bool:
        at = bisect_left(self.firsts, first)
        return at < len(self.rows) and self.rows[at][1] <= last

    def add(self, first: int, last: int, rule: int) -> None:
        at = bisect_left(self.firsts, first)
        self.firsts.insert(at, first)
        self.rows.insert(at, (first, last, rule))


class Scanner:
    """Rules behind their key words."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = list(rules)
        self.expressions = compiled(self.rules)
        self.tier = [list(TIERS).index(rule.tier) for rule in self.rules]
        self.by_key: dict[bytes, list[tuple[int, frozenset[bytes]]]] = defaultdict(list)
        for i, rule in enumerate(self.rules):
            keys = [key.encode() for key in rule.keys]
            self.by_key[max(keys, key=len)].append((i, frozenset(keys)))
        self.keys = frozenset(self.by_key)

    def gated(self, words: set[bytes]) -> list[int]:
        """Rules whose key words are all there."""
        return sorted(i for key in self.keys & words for i, keys in self.by_key[key] if keys <= words)

    def matches(self, words: list[bytes], rules: Sequence[int]) -> list[tuple[int, int, int]]:
        """(rule, first word, last word) of all matches."""
        line = b" " + b" ".join(words) + b" "
        found = sorted((m.start(), m.end(), i) for i in rules for m in self.expressions[i].finditer(line))
        out, at, word = [], 0, 0
        for start, end, i in found:
            word += line.count(b" ", at, start)
            at = start
            out.append((i, word, word + line.count(b" ", start + 1, end)))
        return out

    def settle(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """What is kept, by place."""
        phrases, others = Kept(), Kept()
        for i, first, last in sorted(found, key=lambda d: (self.tier[d[0]], d[1] - d[2], d[1], d[0])):
            if phrases.covers(first, last) or others.covers(first, last):
                continue
            if self.tier[i] == 0:
                phrases.add(first, last, i)
            elif not others.lies_in(first, last):
                others.add(first, last, i)
        return [(i, first, last) for first, last, i in sorted(phrases.rows + others.rows)]

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, int]]]:
        words = text_words(text)
        if self.keys.isdisjoint(words):
            return len(words), []
        rules = self.gated(set(words))
        return len(words), self.settle(self.matches(words, rules)) if rules else []


def detect(docs: DataFrame, rules: Sequence[Rule] = tuple(RULES)) -> DataFrame:
    """doc_id, n_words and found: the kept detections (label, tier, first, last, sure) by place; words count from 0."""
    rules = [tuple(rule) for rule in rules]
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, "
              "found array<struct<label string, tier string, first long, last long, sure double>>")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner([Rule(*rule) for rule in rules])
        for batch in batches:
            sizes, rows = [], []
            for text in batch["text"]:
                n, kept = scanner.scan(text)
                sizes.append(n)
                rows.append([{"label": scanner.rules[i].label, "tier": scanner.rules[i].tier, "first": a, "last": b,
                              "sure": TIERS[scanner.rules[i].tier]} for i, a, b in kept])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": sizes, "found": rows})

    return docs.select("doc_id", "text").mapInPandas(look, schema)
