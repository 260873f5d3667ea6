"""Language identification with spans for texts of several languages.

A word's score under a language is the sum of the log probabilities of its byte
trigrams (with the word's ends), hashed into ``2 ** BITS`` buckets. The script of a word, by
the ranges of its characters, leaves only languages that were seen in that script; the word is
scored under these alone, and not at all where there is one. A Viterbi
pass over the words of a document, with a penalty for each change of language, labels
spans. The document's language is that of most of its word bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textscan

BITS = 16
SWITCH = 10.0  # nats a change of language costs
RARE = 0.001  # a language uses a script if that share of its words does
SMOOTHING = 0.1

# Letters: ASCII letters and everything beyond ASCII.
LETTERS = textscan.byte_table((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

# First code point and script of each range.
SCRIPTS = [
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0780, "other"),
    (0x0900, "devanagari"),
    (0x0980, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x1400, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "han"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
]
_NAMES = ["latin", *sorted({name for _, name in SCRIPTS} - {"latin", "other"})]
_STARTS = np.array([first for first, _ in SCRIPTS])
_CODES = np.array([_NAMES.index(name) if name != "other" else 0 for _, name in SCRIPTS])


def _scripts(piece: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Script of each word: that of a character beyond Latin if it has one."""
    code = np.zeros(len(piece), dtype=np.int64)
    lead = np.flatnonzero(piece >= 0xC0)
    if len(lead):
        follow = [np.where(lead + k < len(piece), piece[np.minimum(lead + k, len(piece) - 1)], 0).astype(np.int64) & 0x3F for k in (1, 2, 3)]
        first = piece[lead].astype(np.int64)
        two = ((first & 0x1F) << 6) | follow[0]
        three = ((first & 0x0F) << 12) | (follow[0] << 6) | follow[1]
        four = ((first & 0x07) << 18) | (follow[0] << 12) | (follow[1] << 6) | follow[2]
        point = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
        code[lead] = _CODES[np.searchsorted(_STARTS, point, side="right") - 1]
    return np.maximum.reduceat(code, starts)


def _trigrams(piece: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bucket at every byte, whether it is in a word, and the words' starts and ends."""
    inside = LETTERS[piece]
    starts, ends = textscan.edges(inside, places)
    here = np.where(inside, piece, 0).astype(np.uint32)
    before = np.concatenate([[np.uint32(0)], here[:-1]])
    before[starts] = 0
    after = np.concatenate([here[1:], [np.uint32(0)]])
    after[ends - 1] = 0
    code = ((before << np.uint32(16)) | (here << np.uint32(8)) | after) * np.uint32(0x9E3779B1)
    return code >> np.uint32(32 - BITS), inside, starts, ends


def _walk(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, places = textscan.utf8(column)
    for at, end in textscan.cuts(data, places, LETTERS):
        low, high = np.searchsorted(places, [at, end])
        yield at, textscan.LOWER[data[at:end]], places[low:high] - at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = (1 << BITS) + len(_NAMES)
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang in set(langs):
            texts = batch.column("text").filter(pa.array([x == lang for x in langs]))
            total = totals.setdefault(lang, np.zeros(size, dtype=np.int64))
            for _, piece, places in _walk(texts):
                code, inside, starts, _ = _trigrams(piece, places)
                total[: 1 << BITS] += np.bincount(code[inside], minlength=1 << BITS)
                if len(starts):
                    total[1 << BITS :] += np.bincount(_scripts(piece, starts), minlength=len(_NAMES))
    for lang, total in totals.items():
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["lang", "bucket", "n"]
        )


@dataclass
class Model:
    """Log probabilities by bucket and language; by script and language 0, or minus infinity if it is not used."""

    langs: list[str]
    score: np.ndarray
    script: np.ndarray


def remainder(doc_id: str, of: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % of


def learn(docs: DataFrame) -> Model:
    """Count trigrams and scripts by ``lang`` over all given ``docs`` with a text and a language.

    The driver gets at most 65,536 counts and the script counts for each language.
    """
    given = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = given.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros(((1 << BITS) + len(_NAMES), len(langs)))
    table[counts["bucket"].to_numpy(), np.searchsorted(langs, counts["lang"])] = counts["n"]
    grams, words = table[: 1 << BITS], table[1 << BITS :]
    score = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * (1 << BITS)))
    used = words >= RARE * words.sum(axis=0)
    used[~used.any(axis=1)] = True  # a script that no language uses leaves them all
    return Model(langs, score.astype(np.float32), np.where(used, 0.0, -np.inf))


def _viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word; documents of similar length are worked on together."""
    sizes = np.diff(first)
    labels = np.zeros(len(scores), dtype=np.int16)
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        many = 512
        while many > 1 and many * int(sizes[order[min(at + many, len(order)) - 1]]) > 1 << 20:
            many //= 2
        group = order[at : at + many]
        at += many
        longest = int(sizes[group].max())
        step = np.arange(longest)
        there = step[None, :] < sizes[group][:, None]
        where = np.where(there, first[group][:, None] + step[None, :], 0)
        came = np.zeros((longest, len(group)), dtype=np.int16)
        changed = np.zeros((longest, len(group), scores.shape[1]), dtype=bool)
        best = scores[where[:, 0]].copy()
        rows = np.arange(len(group))
        for t in range(1, longest):
            top = best.argmax(axis=1)
            jump = best[rows, top] - switch
            moved = jump[:, None] > best
            value = np.where(moved, jump[:, None], best) + scores[where[:, t]]
            live = there[:, t]
            came[t], changed[t] = top, moved & live[:, None]
            best = np.where(live[:, None], value, best)
        state = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            live = there[:, t]
            labels[where[live, t]] = state[live]
            state = np.where(changed[t][rows, state], came[t], state)
    return labels


def word_scores(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of every word under its candidates (minus infinity elsewhere), words' bytes, and the first word of each row."""
    values, sizes, begins = [], [], []
    for at, piece, places in _walk(column):
        code, inside, starts, ends = _trigrams(piece, places)
        if len(starts):
            size = ends - starts
            script, code = _scripts(piece, starts), code[inside]
            value = model.script[script]
            for one in np.unique(script):
                langs, own = np.flatnonzero(np.isfinite(model.script[one])), script == one
                if len(langs) > 1:
                    each = model.score[code[np.repeat(own, size)]]
                    each = each if len(langs) == each.shape[1] else each[:, langs]
                    value[np.ix_(own, langs)] = np.add.reduceat(each, np.cumsum(size[own]) - size[own], axis=0)
            values.append(value)
            sizes.append(size)
            begins.append(starts + at)
    _, rows = textscan.utf8(column)
    if not values:
        return np.zeros((0, len(model.langs))), np.zeros(0, dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    return np.concatenate(values), np.concatenate(sizes), np.searchsorted(np.concatenate(begins), rows)


def _label(model: Model, switch: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.langs, "und"], dtype=object)
        for batch in batches:
            for part in textscan.pieces_of(batch, "text", 2 << 20):
                scores, sizes, first = word_scores(part.column("text"), model)
                label = _viterbi(scores, first, switch)
                owner = np.repeat(np.arange(part.num_rows), np.diff(first))
                share = np.zeros((part.num_rows, len(names)))
                np.add.at(share, (owner, label), sizes)
                known = part.column("lettered").to_numpy(zero_copy_only=False).astype(bool) & (share.sum(axis=1) > 0)
                top = np.where(known, share.argmax(axis=1), len(names) - 1)
                score = np.where(known, share.max(axis=1) / np.maximum(share.sum(axis=1), 1), 0.0)
                turn = np.ones(len(label), dtype=bool)
                turn[1:] = (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])
                start = np.flatnonzero(turn)
                stop = np.concatenate([start[1:], [len(label)]]) if len(start) else start
                base = first[owner[start]] if len(start) else start
                spans = pa.StructArray.from_arrays(
                    [pa.array(names[label[start]], pa.string()), pa.array(start - base, pa.int64()), pa.array(stop - base, pa.int64())], names=["lang", "start", "stop"]
                )
                at = pa.array(np.searchsorted(start, first).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names[top], pa.string()), pa.array(score), pa.ListArray.from_arrays(at, spans)],
                    names=["doc_id", "lang_pred", "score", "spans"],
                )

    return run


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """Language and language spans of every document.

    ``docs``: ``doc_id``, ``text``; nothing else is read. A row per row with ``doc_id``,
    ``lang_pred``, ``score`` (share of word bytes in that language) and ``spans`` (language,
    first word, word after the last; words are runs of letters). Texts that are null or have no
    letter are ``und`` with score 0; so is everything if the model knows no language.
    Ties go to the language that sorts first.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    if not model.langs:
        none = F.array().cast("array<struct<lang:string,start:long,stop:long>>")
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("spans"))
    read = docs.select("doc_id", text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return read.mapInArrow(_label(model, switch), f"doc_id {kind}, lang_pred string, score double, spans array<struct<lang:string,start:long,stop:long>>")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null id is neither learned from nor held out."""
    return F.coalesce(remainder(doc_id, 3) == 1, F.lit(False))


def training(docs: DataFrame) -> DataFrame:
    return docs.where(remainder("doc_id", 3) != 1)
