"""Language ID by cross-parsing entropy over suffix automata.

A suffix automaton per language accepts every substring of that language's
training text.  A word of a text (with a blank before and after) is cut
greedily into phrases: from each start the automaton is followed as far as it
goes (the longest match), then the next phrase begins.  A language's cost is its
number of phrases over the whole text times log2 of its training length (the
bits that point to a phrase); the language with the fewest such normalised
phrases wins, ties going to the first name.  The phrases of a word do not
depend on its neighbours, so a task parses each distinct word once per
language and texts are sums over their words.

The score is the winner's share of 2**-cost over all languages (0 to 1).  The
phrase rate is the winner's phrases per character parsed: about 0.2 to 0.5 in
its own language, 1 in a script that no language was learned in.

Training fits on a bounded sample: the first ``max_rows`` labelled documents of
a language in the order of a hash of the id, up to ``max_chars`` characters.  Prediction
covers every row and the whole text.

Defined results: NULL text, or no letter in it, gives ``und`` with score 0 and rate 1, and
so does every text if no language could be learned; a NULL id is in no fold
(not held out, not learned from); columns other than id, text and label are
ignored; repeated rows each get their row.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylens.llm.common import fold

UND = "und"
HELD_OUT = 2
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORD.findall(text.lower())


class SuffixAutomaton:
    """All substrings of one training text, as a flat transition table over ``alphabet``."""

    def __init__(self, text: str, alphabet: dict[str, int]):
        step: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for ch in text:
            c = alphabet[ch]
            new = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(step)
                    step.append(dict(step[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.width = len(alphabet)
        self.next = array("i", [-1]) * (len(step) * self.width)
        for state, edges in enumerate(step):
            for c, to in edges.items():
                self.next[state * self.width + c] = to

    def phrases(self, codes: list[int]) -> int:
        """Greedy longest-match phrases of one word; an unknown character is a phrase of its own."""
        nxt, width, state, n = self.next, self.width, 0, 0
        for c in codes:
            to = nxt[state * width + c] if c >= 0 else -1
            if to < 0:
                n += state != 0
                to = nxt[c] if c >= 0 else -1
                if to < 0:
                    n, to = n + 1, 0
            state = to
        return n + (state != 0)


class Model:
    def __init__(self, samples: dict[str, str]):
        self.names = sorted(n for n, t in samples.items() if t.strip())
        self.alphabet = {c: i for i, c in enumerate(sorted({" "}.union(*(samples[n] for n in self.names))))}
        self.automata = [SuffixAutomaton(samples[n], self.alphabet) for n in self.names]
        self.bits = np.array([math.log2(len(samples[n]) + 1) for n in self.names])


class _Words(dict):
    """Row number of a word's phrase counts; parses a word when it is first seen."""

    LIMIT = 300_000                                   # words remembered; only a cache

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.rows = np.zeros((1024, len(model.names)), dtype=np.int32)

    def __missing__(self, word: str) -> int:
        get = self.model.alphabet.get
        codes = [get(c, -1) for c in f" {word} "]
        at = len(self)
        if at >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = [a.phrases(codes) for a in self.model.automata]
        self[word] = at
        return at


def classify(words: _Words, text: str | None) -> tuple[str, float, float]:
    """Language, score and phrase rate of one whole text."""
    model = words.model
    found = letters(text) if text else []
    if not model.names or not any(c.isalpha() for w in found for c in w):
        return UND, 0.0, 1.0
    if len(words) > words.LIMIT:
        words.clear()
    rows = np.fromiter(map(words.__getitem__, found), dtype=np.int64, count=len(found))
    phrases = words.rows[rows].sum(axis=0, dtype=np.int64)
    cost = phrases * model.bits
    best = int(np.argmin(cost))
    score = float(1.0 / np.exp2(np.maximum(cost[best] - cost, -1000.0)).sum())
    return model.names[best], score, float(phrases[best] / sum(len(w) + 2 for w in found))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          max_rows: int = 200, max_chars: int = 60_000) -> Model:
    """Learn from labelled rows outside the held-out fold (bounded sample, see the module)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("string").alias("lang"), F.col(text_col).alias("text")
                       ).where((fold() != HELD_OUT) & F.col("lang").isNotNull())
    chosen = _first_ids(rows, max_rows)
    if not chosen:
        return Model({})
    chosen = spark.createDataFrame(chosen, rows.select("lang", "doc_id").schema)    # max_rows a language
    texts = (rows.join(F.broadcast(chosen), ["doc_id", "lang"]).where("text is not null")
             .select("lang", "doc_id", F.substring("text", 1, max_chars).alias("text"))
             .groupBy("lang", "doc_id").agg(F.min("text").alias("text")).collect())         # one text an id
    samples: dict[str, str] = {}
    for r in sorted(texts, key=lambda r: (r["lang"], hash_order(r["doc_id"]), r["text"])):
        so_far = samples.get(r["lang"], " ")
        if len(so_far) < max_chars:
            samples[r["lang"]] = (so_far + "".join(f"{w} " for w in letters(r["text"])))[:max_chars]
    return Model(samples)


def _first_ids(rows: DataFrame, k: int) -> list[tuple]:
    """The first ``k`` distinct ids of every language in hash order, as (lang, doc_id).

    One aggregate tells how many ids a language has, one scan keeps those below a
    hash bound that should hold about 2k of them; a language that falls short
    gets a wider bound in another round.  As many scans for one language as for all.
    """
    order = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    share = {r["lang"]: min(1.0, 2 * k / max(r["n"], 1))
             for r in rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    kept, todo = [], dict(share)
    while todo:
        bounds = rows.sparkSession.createDataFrame([(n, min(int(s * 2 ** 63), 2 ** 63 - 1)) for n, s in todo.items()], "lang string, bound long")
        near = rows.join(F.broadcast(bounds), "lang").where(order <= F.col("bound")).select("lang", "doc_id", order.alias("h")).distinct()
        found: dict[str, list] = {}
        for r in near.collect():
            found.setdefault(r["lang"], []).append((r["h"], r["doc_id"]))
        done = [n for n, s in todo.items() if s == 1.0 or len(found.get(n, [])) >= k]
        kept += [(n, i) for n in done for _, i in sorted(found.get(n, []))[:k]]
        todo = {n: min(1.0, 4 * s) for n, s in todo.items() if n not in done}
    return kept


def hash_order(doc_id) -> bytes:
    return hashlib.blake2b(str(doc_id).encode(), digest_size=8).digest()


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **sample) -> DataFrame:
    """Per document: ``doc_id, held_out, lang_pred, score, phrase_rate``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, label_col, **sample))

    def run(batches):
        words = _Words(model.value)
        for b in batches:
            out = [classify(words, t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] for o in out], pa.float64()), pa.array([o[2] for o in out], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score", "phrase_rate"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col) == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, phrase_rate double")


def keep_identified(docs: DataFrame, max_phrase_rate: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "lang", **sample) -> DataFrame:
    """Documents of an identified language, all columns; those that are ``und``, or that even
    the winner parses almost character by character (phrase rate above ``max_phrase_rate``:
    no learned language), go.  A close race between languages rejects nothing.  A filter on
    the scan."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, label_col, **sample))
    at = docs.columns.index(text_col)

    def run(batches):
        words = _Words(model.value)
        for b in batches:
            out = [classify(words, t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([lang != UND and rate <= max_phrase_rate for lang, _, rate in out], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
