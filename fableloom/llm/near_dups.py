"""Near-duplicates by order MinHash, verified by banded alignment.

Runs of five words, told apart by their number of occurrence, are hashed once
for each band; the two smallest, in the order in which the text has them, are
the band's key, so that equal keys speak for small edit distance and not only
for shared content. Two texts of which a fifth of the words differ still share
one of the 64 keys in nine of ten cases. A few edits leave a short text hardly any
run of five words, so texts of up to 75 words have 64 keys from runs of two besides.

Texts of a key of the first bands, sorted by length, are linked to their
neighbours and to the first of them, which folds most classes with candidates
that grow with the rows. Then all pairs that share a key of any band, are of
compatible length and still of different classes are candidates. Keys of the same
texts are one group. Pairs are listed group by group where a group has few texts,
and compared in blocks inside tasks where it has more. The texts of the largest
groups (a passage that very many share) are cut finer first, without losing a
similar pair: similar texts have so many runs of three words in common that one
must be among the rarest three fifths of either. Word counts rule out most
candidates before their texts are read; the others are aligned word by word within
a band around the diagonal, and the links make classes through connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, materialise, schema_of
from .words import PRIME, WORD, gram_hashes, mix, utf8, word_hashes

K, BANDS, SIMILARITY = 5, 64, 0.8
#: Words of the runs of short texts' further keys, and the words up to which a text is short (and what is like one of up to 60 words).
SHORT_K, SHORT_WORDS = 2, 75
#: Bands by whose keys texts are linked at first, and how many texts back in a key's order.
FIRST_BANDS, NEIGHBOURS = 16, 3
#: Texts of a group whose pairs are listed; those of larger ones are compared in blocks of up to BLOCK texts, of groups over WHOLE texts after these are cut finer.
GROUP, BLOCK, WHOLE = 64, 1 << 12, 1 << 14
#: Groups of a text that its row of a block names.
OTHERS = 128
#: Words of the runs by which the largest groups are cut, and bins of their counts that go to all tasks (2 MB).
RUN, COUNTERS = 3, 1 << 18
#: Bins of word counts, and the fewer that texts of up to SHORT words have.
BINS, FEW_BINS, SHORT = 1024, 128, 200

def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, end to end, and each text's number of words."""
    return word_hashes(utf8((t or "").lower()) for t in texts)


def labelled_grams(words: np.ndarray, sizes: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words (of all words, if fewer) of each text, end to end, and each text's number of them.

    Repeated runs of a text are told apart by their number of occurrence.
    words: hashes of the texts' words, end to end; sizes: each text's.
    """
    starts = np.cumsum(sizes) - sizes
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(sizes)), counts)
    at = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[text]
    runs = gram_hashes(np.concatenate([words, np.zeros(k, np.uint64)]), k)
    h = runs[at]
    for i in np.flatnonzero((sizes > 0) & (sizes < k)):
        h[np.cumsum(counts)[i] - 1] = gram_hashes(words[starts[i] : starts[i] + sizes[i]], int(sizes[i]))[0]
    own = mix(h ^ (text.astype(np.uint64) * PRIME))  # equal only within a text
    order = np.argsort(own, kind="stable")
    new = np.concatenate([[True], own[order][1:] != own[order][:-1]]) if len(own) else np.zeros(0, bool)
    place = np.arange(len(own))
    occurrence = np.empty(len(own), np.uint64)
    occurrence[order] = (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64)
    return mix(h + occurrence * PRIME), counts


def order_keys(grams: np.ndarray, counts: np.ndarray, bands: int = BANDS, first_band: int = 0) -> np.ndarray:
    """Of each text and band: the hash of its two smallest grams in text order. Texts without grams have zeros. Equal grams have other keys under another first band."""
    keys = np.zeros((len(counts), bands), np.uint64)
    own = np.flatnonzero(counts)
    if not len(own):
        return keys
    starts = (np.cumsum(counts) - counts)[own]
    place = np.uint64((1 << 28) - 1)  # the lowest bits hold a gram's place among all
    at, v = np.arange(len(grams), dtype=np.uint64), np.empty_like(grams)
    factors = mix(np.arange(first_band + 1, first_band + bands + 1, dtype=np.uint64) * PRIME) | np.uint64(1)
    single = counts[own] == 1
    for b, factor in enumerate(factors):
        np.multiply(grams, factor, out=v)
        v &= ~place
        v |= at
        first = np.minimum.reduceat(v, starts) & place
        v[first] = np.uint64((1 << 64) - 1)
        second = np.where(single, first, np.minimum.reduceat(v, starts) & place)
        keys[own, b] = mix(mix(grams[np.minimum(first, second)] * PRIME + grams[np.maximum(first, second)]) + np.uint64(first_band + b))
    return keys


def keys_of(texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of words of each text, and its keys: BANDS of them, of short texts as many more, of texts without words none."""
    words, sizes = hashed(texts)
    keys = order_keys(*labelled_grams(words, sizes))
    short = (sizes > 0) & (sizes <= SHORT_WORDS)
    more = iter(order_keys(*labelled_grams(words[np.repeat(short, sizes)], sizes[short], SHORT_K), first_band=BANDS))
    return sizes, [np.concatenate([k, next(more)]) if s else k[:n] for k, s, n in zip(keys, short, np.where(sizes > 0, BANDS, 0), strict=True)]


def by_size(texts: list[str | None], chars: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters together."""
    start, size = 0, 0
    for i, t in enumerate(texts, 1):
        size += len(t or "") + 100
        if size >= chars or i == len(texts):
            yield start, i
            start, size = i, 0


def edit_distance(a: list[str], b: list[str], limit: int) -> int:
    """Insertions, deletions and replacements of words from a to b; limit + 1 if there are more than limit.

    The cells within limit of the diagonal are kept, one column at a time, as
    bits of two numbers: where the distance grows and where it falls from one row
    to the next.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return limit + 1
    head = 0
    while head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(b) - head and a[len(a) - 1 - tail] == b[len(b) - 1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not b:
        return len(a)
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    limit = min(limit, len(a))
    mask = (1 << (2 * limit + 1)) - 1
    goal = 1 << (limit + len(a) - len(b))  # the diagonal that ends at the last cell
    grows, falls, distance = mask >> limit << limit, 0, len(a) - len(b)
    for j, w in enumerate(b, 1):
        down = j - limit - 1
        rows = at.get(w, 0)
        equal = (rows >> down if down >= 0 else rows << -down) & mask
        same = ((((equal & grows) + grows) ^ grows) | equal | falls) & mask
        right_grows = falls | (mask & ~(same | grows))
        right_falls = same & grows
        if not same & goal:
            distance += 1
            if distance > limit:
                return limit + 1
        same >>= 1
        grows = right_falls | (mask & ~(same | right_grows))
        falls = same & right_grows
    return distance


def similar(a: str | None, b: str | None, similarity: float = SIMILARITY) -> bool:
    """Whether 1 - edit distance / words of the longer text reaches the similarity. Near copies need a narrow band only."""
    x, y = words_of(a), words_of(b)
    limit = edits(max(len(x), len(y)), similarity)
    band = 32
    while band < limit:
        if edit_distance(x, y, band) <= band:
            return True
        band *= 4
    return edit_distance(x, y, limit) <= limit


def edits(words: int, similarity: float) -> int:
    """The most edits that similar texts may have, given the words of the longer."""
    return int((1 - similarity) * words + 1e-9)


def numbered(docs: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """doc (the row), row (a number of its own), h1 and h2 (a 128-bit hash of the text) of all rows of docs.

    The table is bucketed by row: its texts move once, and later joins that pick
    rows by number move the numbers only.
    """
    own = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return scratch.bucket(docs.select(row, F.monotonically_increasing_id().alias("row"), F.xxhash64(F.lit(1), own).alias("h1"), F.xxhash64(F.lit(2), own).alias("h2")), "rows", "row")


def distinct_texts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """h1, h2, tid (the first row of the text), copies and first (of its rows: the smallest id, then the smallest row)."""
    first = F.min(F.struct(F.col("doc.doc_id").isNull().alias("no"), F.col("doc.doc_id").alias("doc_id"), F.col("row").alias("row")))
    return scratch.write(rows.groupBy("h1", "h2").agg(F.min("row").alias("tid"), F.count(F.lit(1)).alias("copies"), first.alias("first")), "texts")


def texts_of(rows: DataFrame, ids: DataFrame, text: str) -> DataFrame:
    """ids(tid, ...) with text, from the rows of these numbers; null texts are empty."""
    return rows.select(F.col("row").alias("tid"), F.coalesce(f"doc.`{text}`", F.lit("")).alias("text")).join(ids, "tid")


def text_keys(rows: DataFrame, texts: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """key, band, n (words) and tid of every key of every text, bucketed by key."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, n, keys = list(b), [], []
            for start, end in by_size(texts):
                sizes, own = keys_of(texts[start:end])
                n += sizes.tolist()
                keys += [k.view(np.int64) for k in own]
            yield pd.DataFrame({"n": pd.Series(n, dtype="int32"), "keys": pd.Series(keys, dtype=object)})

    sketch = F.pandas_udf(run, schema_of(n="int", keys="longs")).asNondeterministic()
    own = texts_of(rows, texts.select("tid"), text).select("tid", sketch("text").alias("s")).select("tid", "s.n", F.posexplode("s.keys").alias("band", "key"))
    return scratch.bucket(own.select("key", F.col("band").cast("byte").alias("band"), "n", "tid"), "keys", "key")


def neighbour_pairs(keyed: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """a, b (tids, a before b by length) and votes of texts linked within the keys of the first bands; a key's first text counts twice.

    Keys are range-sorted, so one that very many texts share is spread over tasks;
    which links it gives then depends on where it is cut, but not the classes in
    the end, as all pairs of a key that are still apart are looked at later.
    """
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "n", "tid"]

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        back, lead = np.zeros((0, 3), np.int64), np.zeros(3, np.int64)
        for b in batches:
            if not len(b):
                continue
            own = np.concatenate([back, b[order].to_numpy(np.int64)])
            fresh = len(back)
            starts = np.concatenate([[fresh == 0], own[1:, 0] != own[:-1, 0]])
            first = np.maximum.accumulate(np.where(starts, np.arange(len(own)), -1))
            leads = np.where((first >= 0)[:, None], own[np.maximum(first, 0)], lead)
            pairs = [(leads[fresh:], own[fresh:], 2)]
            for d in range(1, NEIGHBOURS + 1):
                at = np.arange(max(fresh, d), len(own))
                pairs.append((own[at - d], own[at], 1))
            x, y = np.concatenate([p for p, _, _ in pairs]), np.concatenate([q for _, q, _ in pairs])
            votes = np.repeat([v for _, _, v in pairs], [len(q) for _, q, _ in pairs])
            good = (x[:, 0] == y[:, 0]) & (x[:, 2] != y[:, 2]) & (x[:, 1] >= similarity * y[:, 1] - 1e-9)
            yield pd.DataFrame({"a": x[good, 2], "b": y[good, 2], "votes": votes[good]})
            back, lead = own[-NEIGHBOURS:], leads[-1]

    found = keyed.where(F.col("band") < FIRST_BANDS).select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInPandas(link, schema_of(a="long", b="long", votes="long"))
    return scratch.write(found.groupBy("a", "b").agg(F.sum("votes").alias("votes")), "pairs")


def mixed_groups(groups: DataFrame, key: str, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """key, n, tid, c and size of the rows of groups(key, n, tid) whose group holds texts of several classes; of groups of the same texts, one.

    That groups have the same texts is told by 128 bits of these.
    """
    texts = [F.bit_xor(F.xxhash64(F.lit(i), "tid")).alias(f"x{i}") for i in (1, 2)]
    shared = groups.groupBy(key).agg(F.count(F.lit(1)).alias("size"), *texts).where("size > 1").groupBy("size", "x1", "x2").agg(F.min(key).alias(key)).select(key, "size")
    own = groups.select(key, "n", "tid").join(shared, key).join(classes.withColumnRenamed("v", "tid"), "tid", "left")
    own = scratch.write(own.select(key, "n", "tid", "size", F.coalesce("c", "tid").alias("c")), "classed")
    mixed = own.groupBy(key).agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select(key)
    return scratch.write(own.join(mixed, key, "left_semi"), "mixed")


def listed_pairs(groups: DataFrame, key: str, similarity: float) -> DataFrame:
    """a, b (a < b) of all texts of one group that have compatible lengths and different classes. groups: of GROUP texts each at most."""
    x, y = (groups.select(key, F.col("n").alias(f"n{s}"), F.col("tid").alias(s), F.col("c").alias(f"c{s}")) for s in "ab")
    fits = F.least("na", "nb") >= F.lit(similarity) * F.greatest("na", "nb") - 1e-9
    return x.join(y, key).where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & fits).select("a", "b").distinct()


def run_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of RUN words (hashes) of all texts end to end, the same labelled by occurrence, and each text's runs and words."""
    words, sizes = hashed(texts)
    labelled, counts = labelled_grams(words, sizes, RUN)
    starts = np.cumsum(sizes) - sizes
    plain = gram_hashes(np.concatenate([words, np.zeros(RUN, np.uint64)]), RUN)
    text = np.repeat(np.arange(len(sizes)), counts)
    return plain[np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[text]], labelled, counts, sizes


def rare_runs(large: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """token, n and tid of the rarest runs of words of large(tid, n, text): any two similar texts have one of them in common.

    One edit takes RUN runs of a text away at most. So similar texts share all
    but RUN * (1 - similarity) * n of the n words' runs of either, and of both in
    any order of runs that is the same for all, the first so many and one more
    have one in common. The order is by estimated frequency, so that a passage of
    all texts comes last; only sums in COUNTERS bins reach the driver and the tasks.
    Runs that certainly no other text has are left out.
    """
    spark = large.sparkSession

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for start, end in by_size(list(b["text"])):
                plain, _, _, _ = run_counts(list(b["text"].iloc[start:end]))
                sums += np.bincount((plain % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        found = np.flatnonzero(sums)
        yield pd.DataFrame({"bin": found, "n": sums[found]})

    # COUNTERS rows at most, as columns: rows of Python's own would take many times that.
    counted = large.select("text").mapInPandas(count, schema_of(bin="long", n="long")).groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(COUNTERS, np.int64)
    sums[counted["bin"].to_numpy()] = counted["n"].to_numpy()
    shared = spark.sparkContext.broadcast(sums)

    def rarest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sums = shared.value
        for b in batches:
            texts, out = list(b), []
            for start, end in by_size(texts):
                plain, labelled, counts, sizes = run_counts(texts[start:end])
                often = sums[(plain % np.uint64(COUNTERS)).astype(np.int64)]
                at = 0
                for m, n in zip(counts.tolist(), sizes.tolist(), strict=True):
                    order = np.lexsort((labelled[at : at + m], often[at : at + m]))[: int(RUN * (1 - similarity) * n + 1e-9) + 1]
                    out.append(labelled[at : at + m][order[often[at : at + m][order] > 1]].view(np.int64))
                    at += m
            yield pd.Series(out, dtype=object)

    tokens = large.select("tid", "n", F.explode(F.pandas_udf(rarest, "array<bigint>").asNondeterministic()("text")).alias("token"))
    return scratch.write(tokens, "tokens")


def word_bags(texts: list[str | None]) -> tuple[np.ndarray, list[bytes]]:
    """The number of words of each text, and how often each bin of hashed words occurs, up to 255; short texts have fewer bins."""
    words, sizes = hashed(texts)
    parts = np.split(words, np.cumsum(sizes)[:-1])
    bins = [FEW_BINS if len(p) <= SHORT else BINS for p in parts]
    return sizes, [np.minimum(np.bincount((p % np.uint64(b)).astype(np.int64), minlength=b), 255).astype(np.uint8).tobytes() for p, b in zip(parts, bins, strict=True)]


def _bags(xs, few: bool = False) -> np.ndarray:
    """Rows of word counts; in few bins, if any has few. Bins are folded, which is exact for texts that may be similar to short ones."""
    found = [np.frombuffer(x, np.uint8).astype(np.int16) for x in xs]
    if few or any(len(x) == FEW_BINS for x in found):
        found = [x if len(x) == FEW_BINS else x.reshape(-1, FEW_BINS).sum(0) for x in found]
    return np.stack(found) if found else np.zeros((0, BINS), np.int16)


def _may_be_similar(x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Of rows of word counts: one edit takes one word away and adds one at most, so similar texts differ by no more on either side."""
    more = x - y
    return np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1)) <= limit


def with_bags(ids: DataFrame, rows: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """tid, n and bag of the texts of ids(tid)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, n, bags = list(b), [], []
            for start, end in by_size(texts):
                sizes, own = word_bags(texts[start:end])
                n, bags = n + sizes.tolist(), bags + own
            yield pd.DataFrame({"n": pd.Series(n, dtype="int64"), "bag": pd.Series(bags, dtype=object)})

    count = F.pandas_udf(run, schema_of(n="long", bag="binary")).asNondeterministic()
    return scratch.write(texts_of(rows, ids, text).select("tid", count("text").alias("s")).select("tid", "s.n", "s.bag"), "bags")


def sift(pairs: DataFrame, rows: DataFrame, text: str, similarity: float, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) that word counts do not rule out."""
    bags = with_bags(pairs.select(F.explode(F.array("a", "b")).alias("tid")).distinct(), rows, text, scratch)

    def fits(n: pd.Series, m: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        limit = ((1 - similarity) * np.maximum(n, m) + 1e-9).to_numpy().astype(np.int64)
        out, few = np.zeros(len(x), bool), (x.str.len().eq(FEW_BINS) | y.str.len().eq(FEW_BINS)).to_numpy()
        for own in (np.flatnonzero(few), np.flatnonzero(~few)):
            for at in np.array_split(own, len(own) // 1000 + 1):
                if len(at):
                    out[at] = _may_be_similar(_bags(x.iloc[at], bool(few[at[0]])), _bags(y.iloc[at], bool(few[at[0]])), limit[at])
        return pd.Series(out)

    side = lambda s: bags.select(F.col("tid").alias(s), F.col("n").alias(f"n{s}"), F.col("bag").alias(f"bag{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return scratch.write(both.where(F.pandas_udf(fits, "boolean").asNondeterministic()("na", "nb", "baga", "bagb")).select("a", "b"), "sifted")


def compared(g: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """a, b (a < b) of the texts of two blocks i and j of one group that word counts do not rule out and no earlier group holds both of.

    g: i, j, own (the text's block), key, n, tid, c, bag and others (groups of the text).
    """
    i, j, key = g["i"].iat[0], g["j"].iat[0], g["key"].iat[0]
    x, y = g[g["own"] == i], g[g["own"] == j]
    n, tid, c = (y[k].to_numpy(np.int64) for k in ("n", "tid", "c"))
    few = any(len(b) == FEW_BINS for b in g["bag"])
    bags, found, held = _bags(y["bag"], few), [np.zeros((0, 2), np.int64)], {}
    for at, others in enumerate(y["others"]):
        for k in others[others < key].tolist():
            held.setdefault(k, []).append(at)
    held = {k: np.array(v) for k, v in held.items()}
    for m, t, k, bag, others in zip(x["n"], x["tid"], x["c"], x["bag"], x["others"], strict=True):
        longer = np.maximum(n, m)
        limit = ((1 - similarity) * longer + 1e-9).astype(np.int64)
        fits = (c != k) & (longer - np.minimum(n, m) <= limit)
        if i == j:
            fits &= tid > t
        for o in others[others < key].tolist():
            if o in held:
                fits[held[o]] = False
        at = np.flatnonzero(fits)
        at = at[_may_be_similar(bags[at], _bags([bag], few), limit[at])] if len(at) else at
        found.append(np.stack([np.minimum(tid[at], t), np.maximum(tid[at], t)], 1))
    return pd.DataFrame(np.concatenate(found), columns=["a", "b"])


def block_pairs(groups: DataFrame, key: str, rows: DataFrame, text: str, similarity: float, scratch: Scratch) -> DataFrame:
    """As listed_pairs and sift at once, for groups of any size.

    The texts of a group are dealt to blocks of BLOCK by a hash, and each pair of
    blocks is a group of its own; only pairs that word counts do not rule out leave
    a task. Two texts of several groups are compared in the first of these, as far
    as it is among the first OTHERS groups of both.
    """
    bags = with_bags(groups.select("tid").distinct(), rows, text, scratch).select("tid", "bag")
    others = groups.groupBy("tid").agg(F.slice(F.sort_array(F.collect_list(key)), 1, OTHERS).alias("others"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = groups.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("tid"), blocks).cast("int")}).join(bags.join(others, "tid"), "tid")
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = other.select(F.col(key).alias("key"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "n", "tid", "c", "bag", "others")
    return scratch.write(dealt.groupBy("key", "i", "j").applyInPandas(lambda g: compared(g, similarity), schema_of(a="long", b="long")).distinct(), "blocks")


def pairs_apart(rows: DataFrame, keyed: DataFrame, classes: DataFrame, text: str, similarity: float, scratch: Scratch) -> DataFrame:
    """a, b (tids, a < b) of all texts that share a key, are of different classes and may be similar."""
    mixed = mixed_groups(keyed, "key", classes, scratch)
    small, blocks = [(mixed, "key")], [(mixed.where(F.col("size") <= WHOLE), "key")]
    large = mixed.where(F.col("size") > WHOLE).select("tid", "n").distinct()
    if not large.isEmpty():
        read = scratch.write(texts_of(rows, large, text), "large")
        finer = mixed_groups(rare_runs(read, similarity, scratch), "token", classes, scratch)
        scratch.drop(read)
        small, blocks = [*small, (finer, "token")], [*blocks, (finer, "token")]
    pairs = [listed_pairs(g.where(F.col("size") <= GROUP), key, similarity) for g, key in small]
    found = sift(scratch.write(reduce(DataFrame.unionByName, pairs).distinct(), "listed"), rows, text, similarity, scratch)
    for g, key in blocks:
        rest = g.where(F.col("size") > GROUP)
        found = found if rest.isEmpty() else found.unionByName(block_pairs(rest, key, rows, text, similarity, scratch))
    return found.distinct()


def verified(pairs: DataFrame, rows: DataFrame, text: str, similarity: float, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of tids whose texts are similar."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("tid")).distinct()
    texts = scratch.write(texts_of(rows, ids, text), "candidates")

    def check(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([similar(x, y, similarity) for x, y in zip(xs, ys, strict=True)], dtype=bool)

    side = lambda s: texts.select(F.col("tid").alias(s), F.col("text").alias(f"text{s}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    found = scratch.write(both.where(F.pandas_udf(check, "boolean").asNondeterministic()("texta", "textb")).select("a", "b"), "verified")
    scratch.drop(texts)
    return found


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """v and c for every end of links(a, b): one end stands for all that can be reached.

    Each round hooks every end to the first of itself and its neighbours, follows
    the hooks four steps, and goes on with the links between what is left; every
    round is written down. First is by a hash that is another one in each round:
    by the ends themselves, a path whose numbers only grow would lose four ends a
    round, by hashes it is expected to lose more than half.
    """
    ordered = lambda d, a, b: d.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
    steps = []
    links = scratch.write(ordered(links, "a", "b"), "links")
    while not steps or not links.isEmpty():
        placed = lambda v, n=len(steps): F.struct(F.xxhash64(F.lit(n), v).alias("h"), F.col(v).alias("p"))
        ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("v"), placed("b").alias("u")), F.struct(F.col("b").alias("v"), placed("a").alias("u")))).alias("e"))
        first = ends.groupBy(F.col("e.v").alias("v")).agg(F.min("e.u").alias("u"))
        hooks = scratch.write(first.select("v", F.least("u", placed("v"))["p"].alias("p")), "hooks")
        far = hooks.withColumnRenamed("p", "p0")
        for i in range(3):
            far = far.join(hooks.select(F.col("v").alias(f"p{i}"), F.col("p").alias(f"p{i + 1}")), f"p{i}")
        steps.append(scratch.write(far.select("v", F.col("p3").alias("p")), "hooks"))
        side = lambda s: steps[-1].select(F.col("v").alias(s), F.col("p").alias(f"p{s}"))  # noqa: E731, B023
        links = scratch.write(ordered(links.join(side("a"), "a").join(side("b"), "b"), "pa", "pb"), "links")
    out = steps[-1].select("v", F.col("p").alias("c"))
    for step in reversed(steps[:-1]):
        out = step.join(out.withColumnRenamed("v", "p"), "p", "left").select("v", F.coalesce("c", "p").alias("c"))
    return scratch.write(out, "components")


def merged(classes: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The classes, joined by more links between their texts: links between whole classes settle it, however large these are."""
    if links.isEmpty():
        return classes
    label = lambda s: classes.select(F.col("v").alias(s), F.col("c").alias(f"c{s}"))
    between = links.join(label("a"), "a", "left").join(label("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
    settled = components(between, scratch).select(F.col("v").alias("c"), F.col("c").alias("to"))
    every = classes.unionByName(links.select(F.explode(F.array("a", "b")).alias("v")).distinct().join(classes, "v", "left_anti").select("v", F.col("v").alias("c")))
    return scratch.write(every.join(settled, "c", "left").select("v", F.coalesce("to", "c").alias("c")), "merged")


def link_texts(rows: DataFrame, texts: DataFrame, text: str, similarity: float, scratch: Scratch) -> DataFrame:
    """v and c of every text that is similar to another, c the class. rows, texts: of numbered and distinct_texts.

    First each text is aligned with its most voted neighbour only, in doubt the
    one before all others, which folds large groups into shallow trees; then all neighbours that are still in different classes;
    then all other texts of one key that are, until no pair is left out.
    """
    keyed = text_keys(rows, texts, text, scratch)
    pairs = neighbour_pairs(keyed, similarity, scratch)
    best = scratch.write(pairs.groupBy("b").agg(F.max_by("a", F.struct("votes", (-F.col("a")).alias("first"))).alias("a")).select("a", "b"), "best")
    classes = components(verified(best, rows, text, similarity, scratch), scratch)
    label = lambda side: classes.select(F.col("v").alias(side), F.col("c").alias(f"c{side}"))
    apart = pairs.select("a", "b").join(best, ["a", "b"], "left_anti").join(label("a"), "a", "left").join(label("b"), "b", "left")
    apart = scratch.write(apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "apart")
    classes = merged(classes, verified(sift(apart, rows, text, similarity, scratch), rows, text, similarity, scratch), scratch)
    # Pairs that were candidates before are in one class by now or known not to be similar.
    rest = pairs_apart(rows, keyed, classes, text, similarity, scratch)
    scratch.drop(keyed)
    known = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = scratch.write(rest.join(known, ["a", "b"], "left_anti"), "rest")
    return merged(classes, verified(rest, rows, text, similarity, scratch), scratch)


def classed(docs: DataFrame, text: str, similarity: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The numbered rows of docs, and their texts with class_first (as first, of the class), class_size and class_texts."""
    rows = numbered(docs, text, scratch)
    texts = distinct_texts(rows, scratch)
    classes = link_texts(rows, texts, text, similarity, scratch)
    linked = scratch.write(texts.join(classes.withColumnRenamed("v", "tid"), "tid"), "linked")
    sums = scratch.write(linked.groupBy("c").agg(F.min("first").alias("class_first"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("class_texts")), "classes")
    linked = linked.select("tid", "c").join(sums, "c").drop("c")
    alone = texts.join(linked, "tid", "left").select(
        "h1", "h2", "first", F.coalesce("class_first", "first").alias("class_first"), F.coalesce("class_size", "copies").alias("class_size"), F.coalesce("class_texts", F.lit(1).cast("long")).alias("class_texts")
    )
    return rows, scratch.write(alone, "membership")


def find_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """doc_id, class_id, class_size, class_texts and kept for every row of docs(doc_id, text).

    class_id: the smallest doc_id of the class; class_size: its rows; class_texts:
    its different texts; kept: true for one row of each class, the one with that
    id (the first row among repeats; ids before nulls). Null texts count as empty.
    Texts without words are only like texts with the same characters. Long texts
    are taken whole. Other columns are ignored, and an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "near_dups")
    try:
        rows, texts = classed(docs.select("doc_id", text), text, similarity, scratch)
        found = rows.select("doc.doc_id", "row", "h1", "h2").join(texts, ["h1", "h2"])
        return materialise(found.select("doc_id", F.col("class_first.doc_id").alias("class_id"), "class_size", "class_texts", (F.col("row") == F.col("class_first.row")).alias("kept")), "near-duplicates")
    finally:
        scratch.clear()


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """The rows of docs that find_near_duplicates keeps, with all their columns, whatever these are called."""
    scratch = Scratch(docs.sparkSession, "near_dups")
    try:
        rows, texts = classed(docs, text, similarity, scratch)
        kept = texts.where(F.col("first.row") == F.col("class_first.row")).select(F.col("first.row").alias("row"))
        return materialise(rows.join(kept, "row", "left_semi").select("doc.*"), "near-dups-kept")
    finally:
        scratch.clear()
