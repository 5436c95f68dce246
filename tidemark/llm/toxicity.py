"""Toxicity: Levenshtein automata walked through a lexicon trie, scored by the words around a hit."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import texts, workers
from tidemark.llm.quality import held_out
from tidemark.session import stored

# Terms known without any labels, and the words that show a quotation or an address.
KNOWN = (
    "idiot", "moron", "imbecile", "scumbag", "bastard", "asshole", "bitch", "retard", "dumbass",
)
QUOTING = (
    "said", "says", "wrote", "writes", "called", "quote", "quoted", "term", "word", "phrase",
    "sagte", "schrieb", "zitat", "wort", "dijo", "escribió", "palabra", "dit", "écrit", "mot",
)
ADDRESSING = ("you", "your", "youre", "du", "dich", "dein", "tu", "eres", "usted", "vous", "votre")

SAMPLE = 8192  # labelled documents of each kind that the model is fitted on, at most
LEXICON = 512  # learned terms, at most
SHINGLE = 5  # words by which copies among the examples are told
SHORTEST, LONGEST = 4, 12  # letters of a learned term
MARGIN = np.log(2.0)  # of evidence beyond what the best of all terms shows by chance
WINDOW = 8  # words on either side of a hit
RIDGE = 0.05
FEATURES = 6
LAST = 1 << 40

_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_LETTER = ((_BYTES >= 97) & (_BYTES <= 122)) | _DIGIT | (_BYTES >= 128)
_VEILED = np.isin(_BYTES, [ord(c) for c in "*@$"])


def errors_allowed(term: str) -> int:
    """Misspellings a term may have: none below 5 letters, one to 8, two beyond."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


@dataclass
class Part:
    """The words of some whole texts: where they start, a hash, and the first word of each text."""

    content: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray


def _beyond_ascii_marks(content: np.ndarray) -> np.ndarray:
    """Bytes of U+0080 to U+00BF and of U+2000 to U+207F: marks and blanks, among them quotes."""
    out = np.zeros(len(content), bool)
    two = np.flatnonzero(content[:-1] == 0xC2)
    three = np.flatnonzero((content[:-2] == 0xE2) & (content[1:-1] >> 1 == 0x40))
    for at, size in ((two, 2), (three, 3)):
        for k in range(size):
            out[at + k] = True
    return out


def read(column: pa.Array) -> Iterator[Part]:
    """Lower-cased texts in parts of whole texts. A word is a run of letters and digits; `*`, `@`
    and `$` between two of them belong to it too."""
    content, offsets = texts.flat(pc.utf8_lower(column.cast(pa.large_string())))
    for first, last in texts.parts(offsets):
        base = offsets[first]
        part, own = content[base : offsets[last]], offsets[first : last + 1] - base
        inner = _LETTER[part] & ~_beyond_ascii_marks(part)
        veiled = np.zeros(len(part), bool)
        veiled[1:-1] = _VEILED[part[1:-1]] & inner[:-2] & inner[2:]
        words = np.where(inner | veiled, part, np.uint8(32))
        yield Part(part, own, *texts.words(words, own))


def spelled(part: Part, places: np.ndarray, longest: int) -> list[str]:
    """The words at these places, cut behind `longest` letters."""
    found = []
    for a, b in zip(part.starts[places], part.ends[places], strict=True):
        word = part.content[a : min(b, a + 4 * longest)].tobytes()
        found.append(word.decode("utf-8", "ignore")[:longest])
    return found


class Lexicon:
    """A trie of terms, and the automata that walk it."""

    def __init__(self, weights: dict[str, float]):
        self.terms = sorted(weights)
        self.weights = np.array([weights[t] for t in self.terms])
        self.longest = max(map(len, self.terms), default=0) + 3
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.allowed: list[int] = [0]  # most errors of any term below a node
        for number, term in enumerate(self.terms):
            node, k = 0, errors_allowed(term)
            self.allowed[0] = max(self.allowed[0], k)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.ends)
                    self.children.append({})
                    self.ends.append(-1)
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], k)
            self.ends[node] = number

    def matches(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(term or -1, errors) of every word.

        Every word is an automaton whose state is a set of (letters read, errors), one bit each; all
        words step through the trie together and leave a branch once their set is empty. A word
        matches a term that it begins with, or that it is within the allowed errors of as a whole.
        The term of fewest errors counts, then the longest, then the first. Words are to be cut
        behind `longest` letters, which no match can see beyond.
        """
        n = len(words)
        best = np.full(n, LAST, np.int64)  # errors, shortness and number in one key
        if not n or not self.terms:
            return np.full(n, -1), np.zeros(n, int)
        codes = np.array(words, dtype=f"U{self.longest}").view(np.uint32).reshape(n, -1)
        places = np.uint64(1) << np.arange(self.longest, dtype=np.uint64)
        length = (codes != 0).sum(axis=1).astype(np.uint64)
        everything = (np.uint64(1) << (length + np.uint64(1))) - np.uint64(1)
        whole = np.uint64(1) << length
        # a word of `longest` letters, cut or not, is too long to be a whole match
        whole[length == self.longest] = 0
        masks = {}
        for letter in {c for kids in self.children for c in kids}:
            masks[letter] = ((codes == ord(letter)) * places).sum(axis=1, dtype=np.uint64)
        one, key_of = np.uint64(1), [(99 - len(t)) * 4096 + k for k, t in enumerate(self.terms)]

        def walk(node: int, alive: np.ndarray, states: list[np.ndarray]) -> None:
            number = self.ends[node]
            if number >= 0:
                for e in range(min(len(states), errors_allowed(self.terms[number]) + 1)):
                    hit = states[e] != 0 if e == 0 else (states[e] & whole[alive]) != 0
                    rows = alive[hit]
                    best[rows] = np.minimum(best[rows], e * (100 * 4096) + key_of[number])
            for letter, child in self.children[node].items():
                mask, after = masks[letter][alive], []
                for e, state in enumerate(states[: self.allowed[child] + 1]):
                    moved = (state & mask) << one
                    if e:
                        moved |= states[e - 1] | (states[e - 1] << one) | (after[-1] << one)
                    after.append(moved & everything[alive])
                # sets grow with the errors, so the last one tells who is still in the race
                left = np.flatnonzero(after[-1])
                if len(left):
                    walk(child, alive[left], [a[left] for a in after])

        start = [np.full(n, (1 << (e + 1)) - 1, np.uint64) & everything for e in range(3)]
        walk(0, np.arange(n), start[: self.allowed[0] + 1])
        found = best < LAST
        errors = np.where(found, best // (100 * 4096), 0)
        return np.where(found, best % 4096, -1), errors


def _within(flags: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sum of `flags` over the words from WINDOW before to WINDOW after each, inside its text."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[np.minimum(at + WINDOW + 1, last)] - total[np.maximum(at - WINDOW, first)]


def _inside_quotes(part: Part, at: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a quotation is open at each of these words: one that began at most WINDOW words before
    and ends at most WINDOW words after, on the same line of the same text."""
    content = part.content
    plain = content == 34
    opened, closed = np.zeros(len(content), bool), np.zeros(len(content), bool)
    if len(content) > 2:  # U+201C U+201D U+201E, and the angled ones of U+00AB U+00BB
        curly = (content[:-2] == 0xE2) & (content[1:-1] == 0x80)
        opened[:-2] |= curly & np.isin(content[2:], [0x9C, 0x9E])
        closed[:-2] |= curly & (content[2:] == 0x9D)
        angled = content[:-1] == 0xC2
        opened[:-1] |= angled & (content[1:] == 0xAB)
        closed[:-1] |= angled & (content[1:] == 0xBB)
    breaks = np.flatnonzero(content == 10)

    def count(flags: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[np.maximum(a, b)] - total[a]

    first, last = part.at[text], part.at[text + 1]
    here, stop = part.starts[at], part.ends[at]
    next_break = np.searchsorted(breaks, here)
    bounded = np.concatenate([[-1], breaks, [len(content)]])
    line_begin = np.maximum(part.offsets[text], bounded[next_break] + 1)
    line_end = np.minimum(part.offsets[text + 1], bounded[next_break + 1])
    # marks next to the outermost words of the window count too
    begin = np.maximum(part.starts[np.maximum(at - WINDOW, first)] - 3, line_begin)
    end = np.minimum(part.ends[np.minimum(at + WINDOW, last - 1)] + 3, line_end)
    open_curly = count(opened, begin, here) > count(closed, begin, here)
    odd = count(plain, line_begin, here) % 2 == 1
    return (odd & (count(plain, begin, here) > 0) & (count(plain, stop, end) > 0)) | (
        open_curly & (count(closed, stop, end) > 0)
    )


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row for every text: abuse spelled right, misspelled, the densest window, abuse addressed
    to someone, abuse for its length, and quoted abuse; zeros where no term is found."""
    out, row = np.zeros((len(column), FEATURES)), 0
    marks = {kind: None for kind in (QUOTING, ADDRESSING)}
    for kind in marks:
        joined = " ".join(kind).encode()
        marks[kind] = texts.words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]))[0]
    for part in read(column):
        n = len(part.offsets) - 1
        distinct, sample, which = np.unique(part.hashes, return_index=True, return_inverse=True)
        term, errors = lexicon.matches(spelled(part, sample, lexicon.longest))
        at = np.flatnonzero(term[which] >= 0)
        if len(at):
            kind, wrong = term[which[at]], errors[which[at]]
            text = np.searchsorted(part.at, at, side="right") - 1
            first, last = part.at[text], part.at[text + 1]
            quoting, addressing = (
                np.isin(distinct, marks[m])[which] for m in (QUOTING, ADDRESSING)
            )
            quoted = _inside_quotes(part, at, text)
            before = np.concatenate([[0], np.cumsum(quoting)])
            quoted |= before[at] > before[np.maximum(at - 3, first)]
            weight = lexicon.weights[kind] * 0.5**wrong
            abuse = np.where(quoted, 0.0, weight)
            right = wrong == 0
            spread = np.zeros(len(part.hashes))
            spread[at] = abuse
            dense = np.zeros(n)
            np.maximum.at(dense, text, _within(spread, at, first, last))
            addressed = abuse * (_within(addressing, at, first, last) > 0)

            def of_text(values: np.ndarray) -> np.ndarray:
                return np.bincount(text, values, n)  # noqa: B023

            words = np.maximum(np.diff(part.at), 1)
            out[row : row + n] = np.stack(
                [
                    np.log1p(of_text(abuse * right)),
                    np.log1p(of_text(abuse * ~right)),
                    np.log1p(dense),
                    np.log1p(of_text(addressed)),
                    np.log1p(100 * of_text(abuse * right) / words),
                    np.log1p(of_text(weight * quoted)),
                ],
                axis=1,
            )
        row += n
    return out


def stems(column: pa.Array) -> Iterator[set[str]]:
    """For each text, the beginnings of SHORTEST to LONGEST letters of its words."""
    for part in read(column):
        for a, b in zip(part.at[:-1], part.at[1:], strict=True):
            places = a + np.unique(part.hashes[a:b], return_index=True)[1]
            words = spelled(part, places, LONGEST)
            yield {w[:k] for w in words for k in range(SHORTEST, len(w) + 1) if not w[:k].isdigit()}


def sketches(column: pa.Array) -> np.ndarray:
    """For each text, the least hash of its SHINGLE-word shingles, of its words if it has fewer."""
    out = []
    for part in read(column):
        shingles = texts.ngrams(part.hashes, SHINGLE)
        for a, b in zip(part.at[:-1], part.at[1:], strict=True):
            held = shingles[a : b - SHINGLE + 1] if b - a >= SHINGLE else part.hashes[a:b]
            out.append(held.min(initial=np.uint64(2**64 - 1)))
    return np.array(out, np.uint64).view(np.int64)


def told_apart(examples: DataFrame) -> DataFrame:
    """One example of each sketch: most copies and near copies of a text agree in theirs, and would
    otherwise make terms of whatever words they repeat."""

    @workers.lean
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sketches(batch.column(0)))],
                names=["text", "toxic", "sketch"],
            )

    rows = examples.select("text", "toxic")
    rows = rows.mapInArrow(sketch, "text string, toxic int, sketch long")
    one = rows.groupBy("sketch").agg(F.min(F.struct("text", "toxic")).alias("one"))
    return stored(one.select("one.*"))


def sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of at most `sample` labelled documents of each kind, held-out ones left out.

    Those of the smallest hash of the id; of rows that repeat an id, the smallest text. The ids are
    drawn from `labels`, so their number is bounded before they meet any text.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id")
    known = known.agg((F.avg(F.col("toxic").cast("double")) >= 0.5).cast("int").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id"), 5, 0))
    drawn = [
        known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for kind in (0, 1)
    ]
    drawn = stored(drawn[0].unionByName(drawn[1]))
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return found.groupBy("doc_id").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("toxic").alias("toxic")
    )


def learned(examples: DataFrame, known: Sequence[str]) -> dict[str, float]:
    """Weight of each term: the stems that mark toxic examples beyond chance, and the known terms.

    A stem of `pos` toxic texts among `df` has evidence df * KL(pos / df, share of toxic texts), the
    exponent of Chernoff's bound on its chance; it must exceed the logarithm of the number of stems.
    Of stems that begin with each other the strongest stands, of equal ones the longest. Weights
    are log odds, smoothed by half a text.
    """
    examples = told_apart(examples)
    totals = {r.toxic: r.n for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    weights = {term: 2.0 for term in known}
    if not n0 or not n1:
        return weights

    @workers.lean
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            df, pos = Counter(), Counter()
            for found, toxic in zip(stems(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                df.update(found)
                if toxic:
                    pos.update(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(df.keys(), pa.string()),
                    pa.array(df.values(), pa.int64()),
                    pa.array([pos[t] for t in df], pa.int64()),
                ],
                names=["term", "df", "pos"],
            )

    per = examples.select("text", "toxic").mapInArrow(counted, "term string, df long, pos long")
    per = per.groupBy("term").agg(F.sum("df").alias("df"), F.sum("pos").alias("pos"))
    per = stored(per.filter("df >= 3"))
    share, rate = F.lit(n1 / (n0 + n1)), F.col("pos") / F.col("df")
    rest = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    gain = F.col("df") * (rate * F.log(rate / share) + rest)
    found: dict[str, float] = {}
    strong = per.filter((F.col("pos") > 0) & (rate > share)).withColumn("gain", gain)
    strong = strong.filter(F.col("gain") > float(np.log(max(per.count(), 1)) + MARGIN))
    order = [F.col("gain").desc(), F.length("term").desc(), "term"]
    for r in strong.orderBy(*order).limit(LEXICON * 16).collect():
        if len(found) >= LEXICON:
            break
        if not any(r.term.startswith(t) or t.startswith(r.term) for t in found):
            odds = ((r.pos + 0.5) / (n1 + 1)) / ((r.df - r.pos + 0.5) / (n0 + 1))
            found[r.term] = float(np.log(odds))
    return weights | found


@dataclass
class Model:
    """A logistic model of the features of a text; without both kinds of labels, of known terms only."""

    lexicon: Lexicon
    weights: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        z = features(column, self.lexicon) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights, the constant last, by Newton steps; the ridge holds all but the constant."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    held = np.diag([ridge * np.sqrt(len(x))] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + held @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + held
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame, labels: DataFrame, known: Sequence[str] = KNOWN, sample: int = SAMPLE
) -> Model:
    """Lexicon and weights from a bounded sample of labelled documents (`sample` of each kind)."""
    workers.ready(docs.sparkSession)
    examples = stored(sampled(docs, labels, sample))
    lexicon = Lexicon(learned(examples, known))

    @workers.lean
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r.tobytes() for r in features(batch.column(0), lexicon)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), batch.column(1)], names=["features", "toxic"]
            )

    # at most 2 * sample rows of 48 bytes
    rows = examples.select("text", "toxic").mapInArrow(describe, "features binary, toxic int")
    rows = sorted((bytes(r.features), r.toxic) for r in rows.collect())
    y = np.array([t for _, t in rows], float)
    if len(y) == 0 or y.min() == y.max():
        return Model(lexicon, np.array([1.0, 0.5, 0.5, 0.5, 0.5, 0.0, -2.0]))
    x = np.frombuffer(b"".join(f for f, _ in rows)).reshape(len(rows), -1)
    return Model(lexicon, logistic(x, y))


def scored(
    docs: DataFrame, labels: DataFrame, known: Sequence[str] = KNOWN, sample: int = SAMPLE
) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of (doc_id, text).

    `labels` holds (doc_id, toxic); rows without a label are not used, several of a document are
    averaged. The lexicon and the weights come from at most `sample` labelled documents of each kind
    that are not held out (crc32(doc_id) mod 5 is not 0); what is scored is the whole text alone, in
    one scan that shuffles nothing.

    A null or empty text has no hit and gets the score of such texts; repeated rows are scored
    alike. Null doc_ids have no label. Without labels of both kinds the known terms alone decide.
    Texts of any length are read in whole; an empty table gives an empty result; other columns are
    not read.
    """
    model = fit(docs, labels, known, sample)

    @workers.lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(found, pa.float64()),
                    pa.array((found >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), 5, 0).alias("held_out"))
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
