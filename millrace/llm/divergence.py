"""How the word use of a language's sources differs.

Of each language the terms in enough of its documents are kept. Every group, a source of a
language, gives every kept term a smoothed share in billionths; a term that it lacks gets its
baseline, so shares differ from the baseline only where the group has the term.

Two sources are compared by the sum of absolute share differences over all kept terms. With
b and p for baselines and shares, terms that neither has add |b - b'| each, and the others
correct that: those of one side by |p - b'|, for which its sorted shares and their running
totals are enough, and those of both by one more term. Only the last needs terms to meet. It is
accumulated by rows (Gustavson): a group scatters each of its terms through the
term-major index into one dense accumulator over its peers, so a pair of postings is an
addition in an array and never a row. Languages are cut into blocks of terms, and each block's
accumulators are whole sums over its terms, which add up. All numbers are integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.textscan import pieces_of
from millrace.session import stage

LEAST_DOCS = 30  # documents of the language that a kept term is in
ADDED = 5  # smoothing: occurrences that every kept term has besides
PARTS = 1_000_000_000
TOP = 50
# Bytes of terms: a-z, A-Z taken as a-z, and everything beyond ASCII. Others part terms.
LETTERS = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 97 <= x <= 122 else 32 for x in range(256))
HELD = 200_000  # distinct (group, term) counts that a task gathers before it hands them on
CELLS = 2_000_000  # numbers in the accumulators of a task


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by group and term; a null term has the group's documents."""
    found: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), n in found.items():
            names = [None, *n]
            inside = docs[lang, source]
            columns = [
                pa.array([lang] * len(names), pa.string()),
                pa.array([source] * len(names), pa.string()),
                pa.array([x if x is None else x.decode() for x in names], pa.string()),
                pa.array([0, *n.values()], pa.int64()),
                pa.array([inside[x] for x in names], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for piece in pieces_of(batch, "text"):
            texts = piece.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
            for lang, source, text in zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), texts, strict=True):
                group = (lang, source)
                if group not in found:
                    found[group], docs[group] = Counter(), Counter()
                before = len(found[group])
                each = Counter(terms(text))
                found[group].update(each)
                docs[group].update(each.keys())
                docs[group][None] += 1
                held += len(found[group]) - before + 1
            if held >= HELD:
                yield from rows()
                found, docs, held = {}, {}, 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences and ``docs``; the row without a term counts the group's documents."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    parts = docs.select(*text).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(PARTS * (n + ADDED) / (total + ADDED * kept)), exact for any counts."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = (wide(n) + F.lit(ADDED)) * F.lit(PARTS).cast("decimal(10,0)")
    bottom = wide(total) + wide(kept) * F.lit(ADDED)
    return F.lit(1).cast("long") + F.call_function("div", top, bottom)


def _widest(block: int, sources: Column) -> Column:
    """Postings of a block: enough that a language's accumulators are no more than its postings."""
    return F.least(F.greatest(4 * sources * sources, F.lit(block)), F.lit(2 * CELLS))


class Audit:
    """Tables of an audit, staged: ``postings`` (``lang``, ``source``, ``term``, ``n``, ``p``, ``lang_p``),
    ``groups`` (``lang``, ``source``, ``total``, ``base``, and of the language ``kept``, ``sources``, ``postings``)."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS) -> None:
        counts = stage(term_counts(docs))
        found = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.count("*").alias("groups"))
        kept = stage(found.where(F.col("docs") >= least_docs).drop("docs"))
        langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"), F.sum("groups").alias("postings"))
        known = stage(counts.where("term is not null").select("lang", "source", "term", "n").join(kept.select("lang", "term", "lang_n"), ["lang", "term"]))
        totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").fillna(0, "total")
        sized = groups.join(groups.groupBy("lang").agg(F.count("*").alias("sources")), "lang").join(langs, "lang", "left")
        sized = sized.fillna(0, ["kept", "lang_total", "postings"])
        # a language without kept terms has no shares; its baselines, which are all alike, are 0
        base = F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.greatest("kept", F.lit(1)))).otherwise(0)
        self.groups = stage(sized.withColumn("base", base))
        shared = known.join(self.groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
        p, lang_p = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
        self.postings = stage(shared.select("lang", "source", "term", "n", p.alias("p"), lang_p.alias("lang_p")))

    def over_used(self, top: int = TOP) -> DataFrame:
        """The ``top`` terms of each group that it uses more than its language, by how much more."""
        more = self.postings.where("p > lang_p").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("lang_p")).alias("value"))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    def peers(self, block: int = 4096, cells: int = CELLS) -> DataFrame:
        """Every other source of each group's language, from the most different to the most alike.

        A language has blocks of at least ``block`` postings, and of more the more sources
        it has; beyond ``cells`` numbers the accumulators of a block are dealt
        to several tasks by rows. A task holds a block's postings and its accumulators.
        """
        slices = F.greatest(F.lit(1), F.ceil(F.col("sources") * F.col("sources") / F.lit(cells)))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("postings") / _widest(block, F.col("sources"))))
        cut = self.groups.withColumn("blocks", blocks.cast("int")).withColumn("slices", slices.cast("int"))
        number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        cut = stage(cut.withColumn("id", number.cast("int")).select("lang", "source", "id", "base", "blocks", "slices"))
        every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
        # each task of a language gets all sources with their baselines
        names = cut.select("lang", "id", "base", "slices", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        names = names.select("lang", "block", every, "id", "base", "slices")
        found = self.postings.select("lang", "source", "term", "p").join(cut.drop("base"), ["lang", "source"])
        found = found.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), every, F.col("id").alias("id"), "term", "p")
        keys = ["lang", "block", "slice"]
        sums = names.groupBy(*keys).cogroup(found.groupBy(*keys)).applyInArrow(_accumulate, "lang string, id int, peers array<int>, sums array<long>")
        flat = sums.select("lang", "id", F.explode(F.arrays_zip("peers", "sums")).alias("x")).select("lang", "id", F.col("x.peers").alias("peer"), F.col("x.sums").alias("sum"))
        values = flat.groupBy("lang", "id", "peer").agg(F.sum("sum").alias("value"))
        here, there = cut.select("lang", "id", "source"), cut.select("lang", F.col("id").alias("peer"), F.col("source").alias("item"))
        named = values.join(here, ["lang", "id"]).join(there, ["lang", "peer"]).select("lang", "source", "item", "value")
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return named.withColumn("rank", F.row_number().over(order))


def _accumulate(key: tuple, names: pa.Table, found: pa.Table) -> pa.Table:
    """Differences of a slice of a language's groups from all of its groups, over one block of terms."""
    lang, _, part = (k.as_py() for k in key)
    ids = names.column("id").to_numpy()
    base = np.empty(len(ids), dtype=np.int64)
    base[ids] = names.column("base").to_numpy()
    rows = range(part, len(base), names.column("slices")[0].as_py()) if len(ids) else range(0)
    sums = difference_rows(base, found.column("id").to_numpy(), found.column("term").combine_chunks(), found.column("p").to_numpy(), rows)
    peers, values, mine = [], [], []
    everyone = np.arange(len(base), dtype=np.int32)
    for row, acc in sums:
        others = everyone != row
        mine.append(row)
        peers.append(everyone[others])
        values.append(acc[others])
    columns = [pa.array([lang] * len(mine), pa.string()), pa.array(mine, pa.int32()), pa.array(peers, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.int64()))]
    return pa.table(columns, names=["lang", "id", "peers", "sums"])


def difference_rows(base: np.ndarray, group: np.ndarray, term: pa.Array, p: np.ndarray, rows: range) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's sum of absolute share differences from every group, over the terms of the block.

    ``base``: baselines by group; ``group``, ``term``, ``p``: the block's postings.
    """
    code = pa.chunked_array([term]).combine_chunks().dictionary_encode().indices.to_numpy() if len(term) else np.zeros(0, dtype=np.int32)
    n_terms, n_groups = int(code.max()) + 1 if len(code) else 0, len(base)
    order = np.argsort(code, kind="stable")  # the term-major index
    index_group, index_p = group[order], p[order]
    first = np.searchsorted(code[order], np.arange(n_terms + 1))
    by_group = np.argsort(group, kind="stable")
    begin = np.searchsorted(group[by_group], np.arange(n_groups + 1))
    held = np.diff(begin)
    # one-sided sums: shares of g against the baseline of h, from sorted shares and running totals
    one_sided = lambda g, at: _distance_sums(p[by_group[begin[g] : begin[g + 1]]], at)
    of_rows = np.array(rows, dtype=np.int64)
    their = np.array([one_sided(h, base[of_rows]) for h in range(n_groups)], dtype=np.int64).reshape(n_groups, len(of_rows))
    for k, g in enumerate(rows):
        apart = np.abs(base[g] - base)
        acc = (n_terms - held[g] - held) * apart + one_sided(g, base) + their[:, k]
        mine = by_group[begin[g] : begin[g + 1]]
        start, count = first[code[mine]], np.diff(first)[code[mine]]
        at = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum()) if len(mine) else np.zeros(0, dtype=np.int64)
        peer, theirs, own = index_group[at], index_p[at], np.repeat(p[mine], count)
        both = np.abs(own - theirs) - np.abs(own - base[peer]) - np.abs(base[g] - theirs) + apart[peer]
        np.add.at(acc, peer, both)
        yield g, acc


def _distance_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of |value - x| over all values, for each x."""
    ordered = np.sort(values)
    below = np.concatenate([[0], np.cumsum(ordered)])
    k = np.searchsorted(ordered, at)
    return at * k - below[k] + (below[-1] - below[k]) - at * (len(ordered) - k)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Differences of every source from its peers and its language.

    ``docs``: ``lang``, ``source``, ``text``, nulls taken as empty; other columns are ignored.
    Terms are runs of letters and of anything beyond ASCII, A-Z as a-z. Columns ``lang``, ``source``,
    ``part``, ``item``, ``value``, ``rank``: ``pair`` rows have the sum of differences from each other
    source of the language (0 if it keeps no terms), ``term`` rows the ``top`` kept terms that the source uses more than
    the language. Ranks go from 1 by falling value, then item. A source without any terms is a
    group too; a single source has no pairs; repeated rows count each; an empty table gives no rows.
    """
    found = Audit(docs, least_docs)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return columns(found.peers(), "pair").union(columns(found.over_used(top), "term"))
