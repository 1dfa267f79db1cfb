"""Operator 12: collocated phrases, counted in counting quotient filters.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and the pieces into words
at spaces and tabs; all counts are per language. A word's id is a 48-bit hash of language
and word. Ids of words frequent enough for a phrase are checked to belong to one word only, over
all documents; if one doesn't, everything is counted again under another seed (then with
64 bits), so counts are exact.

Each task counts n-grams of ids in a counting quotient filter (``quotient_filter``), handing
it on whenever it holds ``HELD`` entries. Filters are shuffled by ranges of their quotient;
the reducers merge the filters of one range at a time and put out the n-grams with
``min_count`` or more. There are four passes over the texts: single words; the frequent words'
names; pairs of frequent words; and the longer phrases all of whose pairs are frequent. A
phrase can't be more frequent than its parts, so nothing is lost. What is frequent is known
to the tasks by a bitmap of hashed n-grams of a fixed size (``BITMAP``, 8 MB): a
false hit costs counting, the count decides.

A frequent n-gram is one entry of each task's filter, so a word in a third of all places is no
large group. The first places of each language are found in two steps: first within hashed
parts of a language, then among the parts' first places.

Defined results: a null text is empty; a null language is ``und`` (and one with a row that says
``und``); repeated rows count each; empty tables give an empty result; other columns don't take
part; ties of score and count are ordered by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockyard.llm.byte_runs import Runs
from stockyard.llm.common import discard, mix64, partitions, stored, text_slices
from stockyard.llm.quotient_filter import Packing, QuotientFilter

LONGEST = 4
BUCKET_BITS = 10
HELD = 1 << 18  # entries of a task's filter before it is handed on
BITMAP = 1 << 26  # bits
SLICE = 2 << 20  # bytes of text at a time
IDS = tuple(f"w{j}" for j in range(1, LONGEST + 1))
_KIND = np.full(256, 2, np.uint8)  # 0: between words, 1: ends a piece, 2: word
_KIND[[0x20, 0x09]] = 0
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 1


def _coded(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the index of each: ``np.unique`` without a sort
    where the values are dense enough for a table."""
    if below > 8 * len(values) + 1024:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(below, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]


class Words:
    """The words of a run of rows: ``index`` by place into ``ids``, ``names`` and ``langs``
    (distinct pairs of language and word), and whether the next word follows in one piece."""

    def __init__(self, batch: pa.RecordBatch, text: str, lang: str, seed: int, bits: int):
        runs = Runs(batch.column(text), _KIND, words=(2,), cut=1)
        coded = pc.fill_null(batch.column(lang), "und").dictionary_encode()
        langs = coded.dictionary.to_pylist()
        row_lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pair = row_lang[runs.row] * max(1, len(runs.words)) + runs.word
        known, self.index = _coded(pair, len(langs) * max(1, len(runs.words)))
        self.word, self.lang = known % max(1, len(runs.words)), known // max(1, len(runs.words))
        self.words, self.langs = runs.words, langs
        by_word = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in runs.words), np.uint64, len(runs.words))
        by_lang = np.fromiter((xxhash.xxh3_64_intdigest(x, seed + 1) for x in langs), np.uint64, len(langs))
        with np.errstate(over="ignore"):
            self.ids = mix64(by_word[self.word] + by_lang[self.lang]) >> np.uint64(64 - bits)
        same = (runs.row[1:] == runs.row[:-1]) & (runs.cut[1:] == runs.cut[:-1])
        self.follows = np.r_[same, False][: len(self.index)]


def spot(ids: np.ndarray) -> np.ndarray:
    """The bit of each n-gram (a row of ids) in the bitmap."""
    out = np.full(len(ids), ids.shape[1], np.uint64)
    for j in range(ids.shape[1]):
        out = mix64(out ^ ids[:, j])
    return (out % np.uint64(BITMAP)).astype(np.int64)


def _has(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = spot(ids)
    return (bitmap[at >> 3] >> (at & 7)) & 1 > 0


def _single(w: Words, bitmap: None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    yield w.ids[:, None], np.bincount(w.index, minlength=len(w.ids))


def _neighbours(w: Words, bitmap: np.ndarray) -> np.ndarray:
    """The places where two words of the bitmap follow each other in a piece."""
    often = _has(bitmap, w.ids[:, None])[w.index]
    return np.flatnonzero(w.follows[:-1] & often[:-1] & often[1:]) if len(often) > 1 else np.zeros(0, np.int64)


def _pairs(w: Words, bitmap: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    i = _neighbours(w, bitmap)
    m = max(1, len(w.ids))
    pair, n = np.unique(w.index[i] * m + w.index[i + 1], return_counts=True)
    yield np.stack([w.ids[pair // m], w.ids[pair % m]], axis=1), n


def _longer(w: Words, bitmaps: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Triples and quadruples all of whose pairs are in the second bitmap (the first is that of
    the words)."""
    words, bitmap = bitmaps
    i = _neighbours(w, words)
    m = max(1, len(w.ids))
    pair, coded = np.unique(w.index[i] * m + w.index[i + 1], return_inverse=True)
    two = np.stack([w.ids[pair // m], w.ids[pair % m]], axis=1)
    often = _has(bitmap, two)
    at = np.full(len(w.index) + 2, -1)  # the frequent pair that begins at each place
    at[i[often[coded]]] = coded[often[coded]]
    i = np.flatnonzero((at[:-2] >= 0) & (at[1:-1] >= 0))
    triple, n = np.unique(at[i] * m + w.index[i + 1 + 1], return_counts=True)
    yield np.concatenate([two[triple // m], w.ids[triple % m][:, None]], axis=1), n
    i = i[at[i + 2] >= 0]
    m = max(1, len(pair))
    both, n = np.unique(at[i] * m + at[i + 2], return_counts=True)
    yield np.concatenate([two[both // m], two[both % m]], axis=1), n


def count_grams(documents: DataFrame, text: str, lang: str, min_count: int, sizes: tuple[int, ...], take, bitmap, seed: int, bits: int) -> DataFrame:
    """(n, w1, ..., w4, f): the n-grams that ``take`` finds, with f >= min_count in all."""
    spark = documents.sparkSession
    box = spark.sparkContext.broadcast(bitmap)
    packing = {n: Packing(n, bits, BUCKET_BITS) for n in sizes}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[QuotientFilter]] = {n: [] for n in sizes}

        def hand_on(n: int) -> Iterator[pa.RecordBatch]:
            if held[n]:
                full = QuotientFilter.merged(held[n])
                held[n] = []
                bucket, data = zip(*full.segments()) if len(full) else ((), ())
                yield pa.record_batch([pa.array([n] * len(bucket), pa.int32()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())], names=["n", "bucket", "filter"])

        for b in batches:
            for part in text_slices([b], text, SLICE):
                for ids, n in take(Words(part, text, lang, seed, bits), box.value):
                    if len(ids):
                        mine = held[ids.shape[1]]
                        mine.append(QuotientFilter.of(packing[ids.shape[1]], ids, n))
                        # Filters merge when they are alike in size, so an entry is merged seldom.
                        while len(mine) > 1 and len(mine[-2]) <= 2 * len(mine[-1]):
                            mine.append(QuotientFilter.merged([mine.pop(), mine.pop()]))
                        if sum(map(len, mine)) > HELD:
                            yield from hand_on(ids.shape[1])
        for n in sizes:
            yield from hand_on(n)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, size = None, [], 0

        def frequent() -> Iterator[pa.RecordBatch]:
            if at is None:
                return
            full = QuotientFilter.merged(parts)
            some = full.counts >= min_count
            ids = QuotientFilter(full.packing, full.values[some], full.counts[some]).ids().view(np.int64)
            n = ids.shape[1]
            ids = np.concatenate([ids, np.zeros((len(ids), LONGEST - n), np.int64)], axis=1)
            yield pa.record_batch([pa.array(np.full(len(ids), n, np.int32)), *(pa.array(c.copy()) for c in ids.T), pa.array(full.counts[some])], names=["n", *IDS, "f"])

        for b in batches:
            for n, bucket, data in zip(*(b.column(c).to_pylist() for c in ("n", "bucket", "filter"))):
                if (n, bucket) != at:
                    yield from frequent()
                    at, parts, size = (n, bucket), [], 0
                parts.append(QuotientFilter.read(packing[n], bucket, data))
                size += len(parts[-1])
                if size > 2 * len(parts[0]) + (1 << 16):  # merge as they come in: memory follows the distinct entries
                    parts = [QuotientFilter.merged(parts)]
                    size = len(parts[0])
        yield from frequent()

    filters = documents.select(text, lang).mapInArrow(count, "n int, bucket int, filter binary")
    dealt = filters.repartition(partitions(spark), "n", "bucket").sortWithinPartitions("n", "bucket")
    return dealt.mapInArrow(merge, ", ".join(["n int", *(f"{w} long" for w in IDS), "f long"]))


def bitmap_of(grams: DataFrame, n: int) -> np.ndarray:
    """The bitmap of the n-grams: ``BITMAP`` bits however many there are."""

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.stack([b.column(w).to_numpy().view(np.uint64) for w in IDS[:n]], axis=1)
            yield pa.record_batch([pa.array(spot(ids))], names=["spot"])

    out = np.zeros(BITMAP // 8, np.uint8)
    at = grams.select(*IDS[:n]).mapInArrow(spots, "spot long")
    words = at.groupBy(F.bitmap_bucket_number("spot").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    # bitmap_bucket_number counts from 1 for spot 1; spot 0 is the last bit of bucket 0.
    for r in words.toArrow().to_pylist():  # at most BITMAP / 32768 + 1 rows of 4 KB
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        found = (r["b"] - 1) * 32768 + 1 + np.flatnonzero(bits) if r["b"] else np.zeros(1, np.int64)
        np.bitwise_or.at(out, found >> 3, (1 << (found & 7)).astype(np.uint8))
    return out


def lexicon(documents: DataFrame, text: str, lang: str, bitmap: np.ndarray, seed: int, bits: int) -> DataFrame:
    """(id, lang, word, f) of the words in the bitmap; with a null id, each language's words in
    all as f."""
    box = documents.sparkSession.sparkContext.broadcast(bitmap)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text, SLICE):
            w = Words(b, text, lang, seed, bits)
            n = np.bincount(w.index, minlength=len(w.ids))
            some = np.flatnonzero(_has(box.value, w.ids[:, None]))
            total = np.bincount(w.lang, n, minlength=len(w.langs)).astype(np.int64)
            k = len(total)
            yield pa.record_batch(
                [
                    pa.array([None] * k + w.ids[some].view(np.int64).tolist(), pa.int64()),
                    pa.array(w.langs + [w.langs[x] for x in w.lang[some].tolist()], pa.string()),
                    pa.array([None] * k + [w.words[x].decode() for x in w.word[some].tolist()], pa.string()),
                    pa.array(np.r_[total, n[some]].astype(np.int64)),
                ],
                names=["id", "lang", "word", "f"],
            )

    found = documents.select(text, lang).mapInArrow(names, "id long, lang string, word string, f long")
    return found.groupBy("id", "lang", "word").agg(F.sum("f").alias("f"))


def frequent_phrases(documents: DataFrame, text: str, lang: str, min_count: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """The frequent n-grams (n, w1, ..., w4, f; n = 1 from the lexicon), the lexicon, and the
    folders that hold them."""
    spark = documents.sparkSession
    for seed in range(100):
        bits = 48 if seed < 2 else 64
        how = (text, lang, min_count)
        single, single_path = stored(count_grams(documents, *how, (1,), _single, None, seed, bits), "cqf-words")
        words_map = bitmap_of(single, 1)
        words, words_path = stored(lexicon(documents, text, lang, words_map, seed, bits), "cqf-lexicon")
        twice = words.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("k"), F.sum("f").alias("f"))
        if twice.filter((F.col("k") > 1) & (F.col("f") >= min_count)).isEmpty():
            break
        discard(spark, single_path, words_path)
    else:
        raise RuntimeError("word ids of 64 bits met under each of 98 seeds")
    pairs, pairs_path = stored(count_grams(documents, *how, (2,), _pairs, words_map, seed, bits), "cqf-pairs")
    longer, longer_path = stored(count_grams(documents, *how, (3, 4), _longer, (words_map, bitmap_of(pairs, 2)), seed, bits), "cqf-longer")
    grams = single.unionByName(pairs).unionByName(longer)
    return grams, words, [single_path, words_path, pairs_path, longer_path]


def _part(a: int, n: int):
    """Ids a to a + n - 1 of a phrase, as the key of an n-gram."""
    return [F.col(IDS[a + j]).alias(f"k{j}") if j < n else F.lit(0).cast("long").alias(f"k{j}") for j in range(LONGEST)]


def phrases(
    documents: DataFrame, min_count: int = 30, top: int = 2000, text: str = "text", lang: str = "lang",
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = documents.sparkSession
    grams, words, paths = frequent_phrases(documents, text, lang, min_count)
    found = grams.filter("n > 1")
    key = [f"k{j}" for j in range(LONGEST)]

    # Parts of longer phrases with four fifths of a part's count or more: those go.
    inner = None
    for n in range(3, LONGEST + 1):
        for m in range(2, n):
            for a in range(n - m + 1):
                rows = found.filter(F.col("n") == n).select(F.lit(m).alias("m"), *_part(a, m), "f")
                inner = rows if inner is None else inner.unionByName(rows)
    inner = inner.groupBy("m", *key).agg(F.max("f").alias("of"))
    join = [F.col("n") == F.col("m"), *(F.col(w) == F.col(k) for w, k in zip(IDS, key)), F.col("of") * 100 >= F.col("f") * 80]
    left, left_path = stored(found.join(inner, join, "left_anti"), "cqf-left")

    # Both parts of every cut, in one join with the counts.
    cuts = None
    for n in range(2, LONGEST + 1):
        for k in range(1, n):
            for side, a, m in (("l", 0, k), ("r", k, n - k)):
                rows = left.filter(F.col("n") == n).select("n", *IDS, "f", F.lit(k).alias("cut"), F.lit(side).alias("side"), F.lit(m).alias("m"), *_part(a, m))
                cuts = rows if cuts is None else cuts.unionByName(rows)
    counts = grams.select(F.col("n").alias("m"), *(F.col(w).alias(k) for w, k in zip(IDS, key)), F.col("f").alias("part_f"))
    sides = cuts.join(counts, ["m", *key]).groupBy("n", *IDS, "f", "cut").agg(
        F.max(F.when(F.col("side") == "l", F.col("part_f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("part_f"))).alias("r"),
    )
    score = F.expr("(cast(2000000 as decimal(10,0)) * cast(f as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = sides.withColumn("score", score.cast("long"))
    best = scored.groupBy("n", *IDS, "f").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    # Names: one row for each place of a phrase, then the phrase again.
    places = best.select("*", F.posexplode(F.slice(F.array(*IDS), 1, F.col("n"))).alias("place", "id"))
    known = words.filter(F.col("id").isNotNull() & (F.col("f") >= min_count)).select("id", "lang", "word")
    named = places.join(known, "id").groupBy("n", *IDS, "f", "best").agg(
        F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("parts")
    )
    rows = named.filter(F.size("parts") == F.col("n")).select(
        "lang", F.array_join(F.transform("parts", lambda p: p["word"]), " ").alias("phrase"), F.col("f").alias("a"), "best.l", "best.r", "best.score",
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = partitions(spark)
    within = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    total = words.filter("id is null").select("lang", F.col("f").alias("n"))
    out, _ = stored(rows.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "cqf-phrases")
    discard(spark, left_path, *paths)
    return out
