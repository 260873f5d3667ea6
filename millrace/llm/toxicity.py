"""Toxicity of texts, with disguised words restored first.

A character model (trigrams of folded bytes) is counted on all documents. Tokens that look
disguised, by digits or signs among letters, letters repeated three times and more, or letters
set apart by spaces or dots, become lattices of what each sign may stand for, and a Viterbi
pass under the character model picks the likeliest reading. Words of the text and restored
words are then scored together.

The score is learned from a bounded sample of labelled rows: features are whole words and
word beginnings of 4 to 7 bytes. Features are chosen one by one, each time the precise one
that explains most toxic documents not explained yet, so that rare words which only
happen to stand in toxic documents (or in copies of one) are not taken. A document's
score is the noisy-or of the precisions of the features it has.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textscan
from millrace.session import stage

PREFIXES = (4, 5, 6, 7)
SAMPLE_ROWS = 20_000  # labelled documents that the score is learned from, at most
LEAST_DOCS = 3  # toxic documents that a feature has to explain, at least
COMMON = 0.05  # a feature of that share of the toxic documents and of no other is taken in any case
FALSE_COST = 3.0  # explained documents that a clean one with the feature outweighs
FALSE_FEATURES = 0.1  # features chosen by chance, expected
LEAST_PRECISION = 0.8

# Character classes of the model: end of word, a-z, digit, and 16 for bytes beyond ASCII.
CLASSES = 44
FOLD = np.zeros(256, dtype=np.int32)
FOLD[ord("a") : ord("z") + 1] = np.arange(1, 27)
FOLD[ord("0") : ord("9") + 1] = 27
FOLD[128:] = 28 + (np.arange(128) & 15)

# Letters that a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
SIGN_COST = 1.0  # nats for reading a sign as a letter
LITERAL_COST = 4.0  # for reading it as itself
GAP_COST = 0.5  # for reading a separator as nothing
RUN_COST = 0.5  # for reading a run of one letter as one or two of it

_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[[ord(c) for c in STANDS_FOR]] = True
_LETTERS = textscan.byte_table((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_ENDING = _SIGNS.copy()
_ENDING[[ord(c) for c in "!|+"]] = False
_SEPARATORS = np.zeros(256, dtype=bool)
_SEPARATORS[[ord(c) for c in ".-_*"]] = True


def _trigram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES**3, dtype=np.int64)
    for batch in batches:
        data, places = textscan.utf8(batch.column("text"))
        for at, end in textscan.cuts(data, places, textscan.ALNUM):
            here = FOLD[textscan.LOWER[data[at:end]]]
            starts = places[slice(*np.searchsorted(places, [at, end]))] - at
            one = np.concatenate([np.zeros(1, np.int32), here[:-1]])
            one[starts] = 0
            two = np.concatenate([np.zeros(1, np.int32), one[:-1]])
            two[one == 0] = 0
            code = (two * CLASSES + one) * CLASSES + here
            total += np.bincount(code[(here > 0) | (one > 0)], minlength=CLASSES**3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a class after two others, from all texts; the driver gets 85,184 counts at most."""
    counted = docs.select(F.col("text").cast("string").alias("text")).where("text is not null").mapInArrow(_trigram_counts, "code long, n long")
    counts = np.zeros(CLASSES**3)
    for code, n in counted.groupBy("code").agg(F.sum("n")).collect():
        counts[code] = n
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 10 * p1) / (two.sum(axis=1, keepdims=True) + 10)
    p3 = (three + 10 * p2) / (three.sum(axis=2, keepdims=True) + 10)
    return np.log(p3)


def _segments(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a token: for each of its parts what it may stand for, and the cost of that."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        c = token[i]
        run = i + 1
        while run < len(token) and token[run] == c:
            run += 1
        if c.isalpha():
            many = run - i
            out.append([(c * many, 0.0)] if many < 3 else [(c, RUN_COST), (c * 2, RUN_COST)])
        elif c in STANDS_FOR:
            read = [(x, SIGN_COST) for x in STANDS_FOR[c]]
            if run - i >= 3:
                read += [(x * 2, SIGN_COST) for x in STANDS_FOR[c]]
            out.append([*read, (c if c.isdigit() else " ", LITERAL_COST)])
        else:
            out.append([("", GAP_COST), (" ", 0.0)])
        i = run
    return out


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest reading of a lower-case token; words in it are separated by spaces."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in [*_segments(token), [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (two, one), (value, read) in states.items():
            for text, cost in options:
                a, b, total = two, one, value - cost
                for c in FOLD[np.frombuffer(text.encode(), dtype=np.uint8)].tolist():
                    if c or b:
                        total += model[a, b, c]
                    a, b = (0 if not b else b) if c else 0, c
                if (a, b) not in after or total > after[a, b][0]:
                    after[a, b] = (total, read + text)
        states = after
    return " ".join(max(states.values())[1].split())


def suspects(column: pa.Array) -> list[list[str]]:
    """Lower-case tokens of each row that may be disguised words, in order."""
    data, places = textscan.utf8(column)
    out: list[list[str]] = [[] for _ in range(len(column))]
    for at, end in textscan.cuts(data, places, textscan.SPACED):
        piece = textscan.LOWER[data[at:end]]
        starts, ends = textscan.edges(textscan.SPACED[piece], places[slice(*np.searchsorted(places, [at, end]))] - at)
        if len(piece) < 3 or not len(starts):
            continue
        letter, sign, apart = _LETTERS[piece], _SIGNS[piece], _SEPARATORS[piece]
        odd = np.zeros(len(piece), dtype=bool)
        # three of a letter; a letter between separators
        odd[:-2] |= letter[:-2] & (piece < 128)[:-2] & (piece[:-2] == piece[1:-1]) & (piece[:-2] == piece[2:])
        odd[:-2] |= apart[:-2] & (letter | sign)[1:-1] & apart[2:]
        odd[np.maximum(ends - 2, starts)] = False  # these reach beyond their token
        odd[ends - 1] = False
        # a sign before a letter; one or two signs that end a word
        before = sign[:-1] & letter[1:]
        before[ends[ends < len(piece)] - 1] = False
        odd[:-1] |= before
        ending = _ENDING[piece]
        stop = np.ones(len(piece), dtype=bool)
        stop[:-1] = ~(letter | sign)[1:]
        odd[1:] |= ending[1:] & letter[:-1] & stop[1:]
        odd[2:] |= ending[2:] & ending[1:-1] & letter[:-2] & stop[2:]
        flagged = np.logical_or.reduceat(odd, starts)
        single = (ends - starts == 1) & (letter | sign)[starts] & (piece[starts] != ord("|"))
        single |= (ends - starts == 2) & (piece[starts] >= 0xC0)
        owner = np.searchsorted(places, starts + at, side="right") - 1
        row = np.flatnonzero(single)
        if len(row):  # runs of three and more single letters of one document
            fresh = np.ones(len(row), dtype=bool)
            fresh[1:] = (row[1:] != row[:-1] + 1) | (owner[row[1:]] != owner[row[:-1]])
            first = np.flatnonzero(fresh)
            size = np.diff(np.concatenate([first, [len(row)]]))
            for f, n in zip(first[size >= 3].tolist(), size[size >= 3].tolist(), strict=True):
                a, b = row[f], row[f] + n - 1
                text = " ".join(bytes(piece[starts[k] : ends[k]]).decode(errors="replace") for k in range(a, b + 1))
                out[owner[a]].append(text)
        for k in np.flatnonzero(flagged).tolist():
            out[owner[k]].append(bytes(piece[starts[k] : ends[k]]).decode(errors="replace"))
    return out


def _restore(column: pa.Array, read) -> pa.Array:
    texts = []
    for tokens in suspects(column):
        found = [read(t) for t in tokens]
        texts.append(" ".join(x for x, t in zip(found, tokens, strict=True) if x and x != t))
    return pa.array(texts, pa.string())


def _reader(model: np.ndarray):
    @functools.lru_cache(maxsize=100_000)
    def read(token: str) -> str:
        core = token.strip(".,;:?\"'()[]{}<>#%&*")
        return decode(core.rstrip("!+|") or core, model) if any(c.isalpha() for c in core) else ""

    return read


def _features(column: pa.Array, restored: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features of the texts and of the restored words, and the row of each; repeats included."""
    hashes, rows = [], []
    for texts in (column, restored):
        words = textscan.scan(texts, textscan.ALNUM, PREFIXES)
        owner = words.owner()
        for value in (words.hash, *words.prefix.values()):
            there = value != 0
            hashes.append(value[there])
            rows.append(owner[there])
    return np.concatenate(hashes), np.concatenate(rows)


def _distinct(column: pa.Array, restored: pa.Array, rows: int) -> tuple[np.ndarray, np.ndarray]:
    value, owner = _features(column, restored)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], owner[new]


def _feature_counts(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(model)
        for batch in batches:
            for part in textscan.pieces_of(batch, "text", 4 << 20):
                value, owner = _distinct(part.column("text"), _restore(part.column("text"), read), part.num_rows)
                toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)[owner]
                unique, at = np.unique(value, return_inverse=True)
                bad = np.bincount(at, weights=toxic, minlength=len(unique)).astype(np.int64)
                every = np.bincount(at, minlength=len(unique))
                yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(bad), pa.array(every - bad)], names=["feature", "bad", "good"])

    return run


def _has(model: np.ndarray, wanted: np.ndarray, keep: list[str]):
    """Columns ``keep`` of each row, the chosen features it has as places in ``wanted`` (sorted), and restored words."""
    quick = np.zeros(1 << 16, dtype=bool)
    quick[wanted >> np.uint64(48)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(model)
        for batch in batches:
            for part in textscan.pieces_of(batch, "text", 2 << 20):
                restored = _restore(part.column("text"), read)
                value, owner = _features(part.column("text"), restored)
                likely = np.flatnonzero(quick[value >> np.uint64(48)])
                value, owner = value[likely], owner[likely]
                place = np.minimum(np.searchsorted(wanted, value), max(0, len(wanted) - 1))
                same = wanted[place] == value if len(wanted) else np.zeros(0, dtype=bool)
                pairs = np.unique(np.stack([owner[same], place[same]], axis=1), axis=0)
                first = np.searchsorted(pairs[:, 0], np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), textscan.lists(pairs[:, 1].astype(np.int32), first, pa.int32()), restored], names=[*keep, "__places", "__restored"]
                )

    return run


@dataclass
class Model:
    """The character model, the chosen features (sorted) with their precisions, and the score without any."""

    characters: np.ndarray
    features: np.ndarray
    precision: np.ndarray
    base: float


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is kept from learning; a null id has no label to learn."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fold, by hash of the id; 16 bytes each."""
    given = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    given = given.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    return given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _least_support(good: np.ndarray, rate: float, features: int) -> np.ndarray:
    """Toxic documents that a feature has to explain, given the others it is in.

    Enough that among ``features`` features less than ``FALSE_FEATURES`` would do so by chance,
    if each document were toxic with the chance ``rate``.
    """
    ways = np.vectorize(math.lgamma, otypes=[float])
    least = np.full(len(good), LEAST_DOCS)
    bound = math.log(FALSE_FEATURES / max(1, features))
    while True:
        chance = ways(least + good + 1) - ways(least + 1) - ways(good + 1) + least * math.log(rate)
        short = chance > bound
        if not short.any() or least.max() > 200:
            return least
        least[short] += 1


def _common(toxic: int) -> int:
    """Toxic documents that make a feature of no other document a common one."""
    return max(10, math.ceil(COMMON * toxic))


def _choose(documents: list[list[int]], bad: np.ndarray, good: np.ndarray, least: np.ndarray) -> tuple[list[int], int]:
    """Features that explain the toxic documents, greedily, and how many stay unexplained."""
    holders: list[list[int]] = [[] for _ in range(len(bad))]
    for d, own in enumerate(documents):
        for f in own:
            holders[f].append(d)
    precision = (bad + 0.5) / (bad + good + 1.0)
    support = np.array([len(h) for h in holders])
    explained = np.zeros(len(documents), dtype=bool)
    chosen: list[int] = []
    while ((support >= least) & (support > FALSE_COST * good)).any():
        gain = np.where(support >= least, support - FALSE_COST * good, -np.inf)
        tops = np.flatnonzero(gain == gain.max())
        f = int(tops[np.argmax(precision[tops])])
        chosen.append(f)
        for d in holders[f]:
            if not explained[d]:
                explained[d] = True
                support[documents[d]] -= 1
        support[f] = 0
    return chosen, int((~explained).sum())


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Character model from all ``docs``; features from at most ``rows`` labelled ones."""
    characters = character_model(docs)
    sample = F.broadcast(labelled_sample(labels, rows))
    text = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    known = stage(text.join(sample, "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("doc_id", F.monotonically_increasing_id()))
    toxic, every = known.agg(F.coalesce(F.sum(F.col("toxic").cast("int")), F.lit(0)), F.count("*")).first()
    counted = known.mapInArrow(_feature_counts(characters), "feature long, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counted = stage(counted.where(F.col("bad") + F.col("good") >= LEAST_DOCS))
    rate, features = min(0.5, max(toxic, 1) / max(every, 2)), counted.count()
    precise = counted.where((F.col("bad") >= LEAST_DOCS) & (F.col("bad") >= LEAST_PRECISION * (F.col("bad") + F.col("good"))))
    # Features in too few toxic documents to be chosen stay behind; how many are enough follows from the clean ones.
    clean = np.array(sorted(r[0] for r in precise.select("good").distinct().collect()), dtype=np.int64)
    enough = _least_support(clean, rate, features)
    enough[clean == 0] = np.minimum(enough[clean == 0], _common(toxic))
    table = known.sparkSession.createDataFrame(list(zip(clean.tolist(), enough.tolist(), strict=True)), "good long, enough long")
    found = precise.join(table, "good").where("bad >= enough").select("feature", "bad", "good").toPandas()
    order = np.argsort(found["feature"].to_numpy(np.int64).view(np.uint64), kind="stable")
    wanted = found["feature"].to_numpy(np.int64).view(np.uint64)[order]
    bad, good = found["bad"].to_numpy(float)[order], found["good"].to_numpy(float)[order]
    held = known.where("toxic").select("doc_id", "text").mapInArrow(_has(characters, wanted, ["doc_id"]), "doc_id long, __places array<int>, __restored string")
    least = _least_support(good, rate, features)
    chosen, left = _choose([r[0] for r in held.select("__places").collect()], bad, good, least)
    common = np.flatnonzero((good == 0) & (bad >= _common(toxic)))
    chosen = sorted({*chosen, *common.tolist()})
    base = min(0.45, (left + 0.5) / (every - toxic + left + 1.0))
    return Model(characters, wanted[chosen], (bad[chosen] + 0.5) / (bad[chosen] + good[chosen] + 1.0), base)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Toxicity of every document.

    ``docs``: ``doc_id``, ``text``; nothing else is read. A row per row with ``doc_id``, ``score``
    (0 to 1), ``predicted`` (1 from 0.5 on) and ``restored`` (readings of disguised words).
    Null and empty texts have the score of a text without any feature. Without
    toxic labels no feature is chosen and nothing is predicted toxic.
    """
    scored = _scored(docs.select("doc_id", F.col("text").cast("string").alias("text")), ["doc_id"], model)
    return scored.select("doc_id", F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"), F.col("__restored").alias("restored"))


def _scored(docs: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """Columns ``keep`` of ``docs``, ``__score`` and ``__restored``."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "__places array<int>", "__restored string"])
    found = docs.mapInArrow(_has(model.characters, model.features, keep), schema)
    clean = F.array(*[F.lit(float(x)) for x in 1 - model.precision]) if len(model.precision) else F.array().cast("array<double>")
    innocent = F.aggregate("__places", F.lit(1 - model.base), lambda a, p: a * F.element_at(clean, p + 1))
    return found.withColumn("__score", 1 - innocent)


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without documents that are predicted toxic, judged by text alone."""
    typed = docs.withColumn("text", F.col("text").cast("string"))
    return _scored(typed, typed.columns, model).where("__score < 0.5").select(*docs.columns)
