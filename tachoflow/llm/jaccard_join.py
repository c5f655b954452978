"""N-gram Jaccard join: groups of documents whose shingle sets are similar enough.

Candidates come from PartEnum signatures (``partenum``), which miss no pair. The work is
spread so that no group of copies is ever paired out:

1. Every text becomes the id of its shingle set with its size and a parity map of about as
   many bits as the set has shingles.
   Documents with equal sets are one set from here on.
2. Sets that share a signature are compared with the smallest of them only (a star). Each
   task first gathers its own sets by signature, so a signature that very many documents
   share reaches the shuffle once per task and chunk.
3. Parity maps differ in no more bits than the sets differ in shingles, so a pair whose maps
   differ too much is no link. The others are verified on the words themselves.
4. If all sets that share a signature are connected by now, nothing is left to compare. For
   the components in which a comparison failed, signatures are made again and sets of
   different components that share one are compared; where many do, in blocks of bounded
   size whose pairs are filtered by parity map before any row is emitted. A first turn takes
   only the nearest partners, so that a second one, which takes all, finds few components;
   it needs only the shared signatures that the first turn found.
5. Components of all links give the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tachoflow.llm.graph import components
from tachoflow.llm.partenum import Bands, set_ids, signatures
from tachoflow.llm.tables import arrow_step, broadcast_if_small, giving_back, release, small_batches, written
from tachoflow.llm.words import LOWER, U64, Texts, distinct_per_text, find_words, hash_words, mix, slices, windows

#: Bits of the smallest and of the largest parity map; larger sets are filtered less sharply.
MAP_BITS = 1 << 10
MOST_MAP_BITS = 1 << 16
#: Sets that share a signature up to this many are paired by id, more in blocks with their maps.
FEW = 8
BLOCK = 2048
#: Partners a set is compared with before all others, where many share a signature.
NEAREST = 2
#: Bytes of text worked on at a time.
SLICE = 1 << 19
#: Signatures a task gathers before it passes them on.
CHUNK = 1 << 19
#: Shingles a task keeps of the texts it compared last.
KEPT_SHINGLES = 1 << 18
#: Set ids a task remembers having signed.
REMEMBERED = 1 << 17


def shingles(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of each text, ordered by text. A text of fewer words is one shingle."""
    texts = texts._replace(data=LOWER[texts.data])
    words = find_words(texts)
    hashes = hash_words(texts.data, words)
    lengths = np.bincount(words.text, minlength=texts.count)
    found = [windows(hashes, words.text, size)]
    for n in range(1, size):
        if (lengths == n).any():
            short = (lengths == n)[words.text]
            value, owner = windows(hashes[short], words.text[short], n)
            found.append((mix(value ^ U64(n)), owner))
    return distinct_per_text(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))


def parity_maps(features: np.ndarray, owner: np.ndarray, count: int) -> pa.Array:
    """One map per set; a bit tells whether an odd number of features fell on it.

    A map has a power of two of bits, at least as many as the set has features (within the
    two bounds). Folding a map's halves together gives the map of half the size.
    """
    sizes = np.bincount(owner, minlength=count)
    bits = np.left_shift(1, np.ceil(np.log2(np.clip(sizes, MAP_BITS, MOST_MAP_BITS))).astype(np.int64))
    start = np.concatenate(([0], np.cumsum(bits)))
    bit = (mix(features ^ U64(0xA0761D6478BD642F)) & (bits[owner] - 1).astype(U64)).astype(np.int64)
    odd = np.bincount(start[owner] + bit, minlength=start[-1]) & 1
    return pa.BinaryArray.from_buffers(pa.binary(), count, [
        None, pa.py_buffer((start // 8).astype(np.int32).tobytes()), pa.py_buffer(np.packbits(odd.astype(np.uint8)).tobytes())])


def folded(maps: list[bytes], size: int) -> np.ndarray:
    """Maps of one length as rows of ``size`` bytes."""
    words = np.frombuffer(b"".join(maps), np.uint64)
    return np.bitwise_xor.reduce(words.reshape(len(maps), -1, size // 8), axis=1)


def map_distances(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Bits in which the maps of each pair differ, at the size of the smaller one."""
    lengths = np.array([[len(a), len(b)] for a, b in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    out = np.zeros(len(left), np.int64)
    for one, two in np.unique(lengths, axis=0):
        at = np.flatnonzero((lengths[:, 0] == one) & (lengths[:, 1] == two))
        size = int(min(one, two))
        out[at] = np.bitwise_count(folded([left[k] for k in at], size) ^ folded([right[k] for k in at], size)).sum(axis=1)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for texts in slices(batch["text"], SLICE):
            features, owner = shingles(texts, size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(texts.first, texts.count),
                    pa.array(_signed(set_ids(features, owner, texts.count))),
                    pa.array(np.bincount(owner, minlength=texts.count)),
                    parity_maps(features, owner, texts.count),
                ],
                ["doc_id", "set_id", "n", "map"],
            )

    return arrow_step(docs, step, "doc_id long, set_id long, n long, map binary")


def _signed_sets(docs: DataFrame, size: int, bands: Bands) -> DataFrame:
    """Rows (sign, member, peer): a set with one of its signatures.

    Where a task holds several sets with one signature, only the smallest goes on with it; a
    row with ``peer`` pairs each other one with that.
    """

    def gathered(signs: list[np.ndarray], members: list[np.ndarray]) -> pa.RecordBatch:
        sign, member = np.concatenate(signs), np.concatenate(members)
        order = np.lexsort((member, sign))
        sign, member = sign[order], member[order]
        first = np.concatenate(([True], sign[1:] != sign[:-1]))
        lead = member[np.flatnonzero(first)][np.cumsum(first) - 1]
        new = np.concatenate(([True], (sign[1:] != sign[:-1]) | (member[1:] != member[:-1])))
        paired = new & ~first
        pairs = np.unique(np.stack([lead[paired], member[paired]], axis=1), axis=0) if paired.any() else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([sign[first], pairs[:, 1]])),
                pa.array(np.concatenate([member[first], pairs[:, 1]])),
                pa.concat_arrays([pa.nulls(int(first.sum()), pa.int64()), pa.array(pairs[:, 0])]),
            ],
            ["sign", "member", "peer"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs, members, held, done = [], [], 0, set()
        for batch in batches:
            for texts in slices(batch["text"], SLICE):
                features, owner = shingles(texts, size)
                ids = _signed(set_ids(features, owner, texts.count))
                again = np.zeros(texts.count, bool)
                for k, one in enumerate(ids.tolist()):
                    again[k] = one in done
                    done.add(one)
                if len(done) > REMEMBERED:
                    done.clear()
                fresh = ~again[owner]
                sign, who = signatures(features[fresh], owner[fresh], texts.count, bands)
                signs.append(_signed(sign))
                members.append(ids[who])
                held += len(sign)
                if held > CHUNK:
                    yield gathered(signs, members)
                    signs, members, held = [], [], 0
        if held:
            yield gathered(signs, members)

    return docs.mapInArrow(giving_back(run), "sign long, member long, peer long")


def _star_pairs(signed: DataFrame) -> DataFrame:
    """Distinct (a, b): each set with the smallest one that shares a signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sign = last_lead = None
        for batch in batches:
            peer = batch["peer"]
            own = np.asarray(peer.is_null().to_numpy(zero_copy_only=False), bool)
            sign, member = batch["sign"].to_numpy()[own], batch["member"].to_numpy()[own]
            a = [peer.drop_null().to_numpy()]
            b = [batch["member"].to_numpy()[~own]]
            if len(sign):
                first = np.concatenate(([sign[0] != last_sign], sign[1:] != sign[:-1]))
                leads = np.concatenate(([0 if last_lead is None else last_lead], member[first]))
                lead = leads[np.cumsum(first)]
                other = lead != member
                a.append(lead[other])
                b.append(member[other])
                last_sign, last_lead = sign[-1], lead[-1]
            pairs = np.stack([np.concatenate(a), np.concatenate(b)], axis=1)
            if len(pairs):
                pairs = np.unique(pairs, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    dealt = signed.repartition("sign").sortWithinPartitions("sign", "member")
    return dealt.mapInArrow(giving_back(run), "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _most_apart(percent: int):
    """Largest symmetric difference of two linked sets of sizes n_a and n_b."""
    return F.floor((F.col("n_a") + F.col("n_b")) * (100 - percent) / (100 + percent))


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that neither their sizes nor their parity maps rule out, with the documents to read."""
    side = lambda x: sets.select(*(F.col(c).alias(f"{c}_{x}" if c != "set_id" else x) for c in ("set_id", "doc_id", "n", "map")))
    near = (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .withColumn("most", _most_apart(percent))
    )

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            apart = map_distances(batch["map_a"].to_pylist(), batch["map_b"].to_pylist())
            yield batch.select(["a", "b", "doc_a", "doc_b"]).filter(pa.array(apart <= batch["most"].to_numpy()))

    return arrow_step(
        near.select("a", "b", F.col("doc_id_a").alias("doc_a"), F.col("doc_id_b").alias("doc_b"), "most", "map_a", "map_b"),
        step, "a long, b long, doc_a long, doc_b long",
    )


def _texts_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Rows (set_id, text), one per wanted set; wanted: written rows (set_id, doc_id)."""
    read = docs.join(broadcast_if_small(wanted.select("doc_id").distinct(), 32), "doc_id", "left_semi")
    if wanted.where("doc_id is null").limit(1).count():
        read = read.unionByName(docs.where("doc_id is null"))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for texts in slices(batch["text"], SLICE):
            features, owner = shingles(texts, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(set_ids(features, owner, texts.count))), batch["text"].slice(texts.first, texts.count)], ["set_id", "text"])

    return arrow_step(read, step, "set_id long, text string").dropDuplicates(["set_id"])


def word_shingles(text: str | None, size: int) -> set[bytes]:
    """Shingles of a text as joined words: what a link is finally decided on."""
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[k:k + size]) for k in range(len(words) - size + 1)}


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, by the words of their texts."""
    both = pairs.select(F.col("a").alias("set_id"), F.col("doc_a").alias("doc_id")).union(pairs.select("b", "doc_b")).distinct()
    texts = _texts_of(docs, written(both, "wanted"), size)
    rows = (
        pairs.select("a", "b")
        .join(texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b")), "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = {}, 0

        def known(name: int, text: pa.Scalar) -> set[bytes]:
            nonlocal held
            found = kept.pop(name, None)
            if found is None:
                found = word_shingles(text.as_py(), size)
                held += len(found)
            # The one used last stands last; the first ones make room.
            kept[name] = found
            while held > KEPT_SHINGLES and len(kept) > 2:
                held -= len(kept.pop(next(iter(kept))))
            return found

        for batch in batches:
            keep = []
            for a, b, text_a, text_b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["text_a"], batch["text_b"], strict=True):
                one, two = known(a, text_a), known(b, text_b)
                met = len(one & two)
                keep.append(100 * met >= percent * (len(one) + len(two) - met))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "text_a", "text_b").mapInArrow(giving_back(run), "a long, b long")


def _paired_in_blocks(rows: DataFrame, percent: int, nearest: int | None) -> DataFrame:
    """Possible pairs of different components within each (sign, low, high) block of rows.

    ``nearest``: only so many pairs for each row, those whose maps differ least.
    """

    def pairs_of(group: list[tuple], rectangle: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        block = np.array([g[0] for g in group])
        member, root, n = (np.array([g[k] for g in group], np.int64) for k in (1, 2, 3))
        # All sets of a signature are of like size, so their maps are of one or two lengths.
        lengths = np.array([len(g[4]) for g in group])
        size = int(lengths.min())
        maps = np.empty((len(group), size // 8), np.uint64)
        for length in np.unique(lengths):
            of_length = np.flatnonzero(lengths == length)
            maps[of_length] = folded([group[k][4] for k in of_length], size)
        for k in range(len(group) - 1):
            rest = slice(k + 1, None)
            most = (n[k] + n[rest]) * (100 - percent) // (100 + percent)
            good = (root[rest] != root[k]) & (np.abs(n[rest] - n[k]) <= most)
            if rectangle:
                good &= block[rest] != block[k]
            at = np.flatnonzero(good)
            apart = np.bitwise_count(maps[rest][at] ^ maps[k]).sum(axis=1)
            at, apart = at[apart <= most[at]], apart[apart <= most[at]]
            if nearest and len(at) > nearest:
                at = at[np.argsort(apart, kind="stable")[:nearest]]
            if len(at):
                yield np.full(len(at), member[k]), member[rest][at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(key: tuple, group: list[tuple]) -> Iterator[pa.RecordBatch]:
            found = list(pairs_of(group, key[1] != key[2]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        key, group = None, []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("sign", "low", "high", "block", "member", "root", "n", "map")]
            for row in zip(*columns, strict=True):
                if row[:3] != key:
                    if group:
                        yield from closed(key, group)
                    key, group = row[:3], []
                group.append(row[3:])
        if group:
            yield from closed(key, group)

    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        rows.withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
        .select("*", other.alias("other"))
        .select("sign", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "member", "root", "n", "map")
        .repartition("sign", "low", "high").sortWithinPartitions("sign", "low", "high")
    )
    return dealt.mapInArrow(giving_back(run), "a long, b long")


def _owned(sets: DataFrame, tried: DataFrame, links: DataFrame) -> DataFrame:
    """Sets with the root of their component, for the components that a comparison failed in."""
    roots = written(components(links), "roots")
    root_of = lambda c: F.coalesce(F.col(f"root_{c}"), F.col(c))
    failed = (
        tried.join(roots.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a", "left")
        .join(roots.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b", "left")
        .select(root_of("a").alias("x"), root_of("b").alias("y")).where("x <> y")
    )
    touched = written(failed.select(F.col("x").alias("root")).union(failed.select("y")).distinct(), "touched")
    owned = sets.join(roots, F.col("set_id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "set_id")).drop("node")
    return written(owned.join(touched, "root", "left_semi").select("set_id", "doc_id", "root", "n", "map"), "open")


def _of_several(rows: DataFrame) -> DataFrame:
    """Rows (sign, member, root, c) of the signatures that c sets of several components share."""
    same = Window.partitionBy("sign")
    return rows.select(
        "sign", "member", "root", F.count("*").over(same).alias("c"), F.min("root").over(same).alias("r"), F.max("root").over(same).alias("s")
    ).where("r < s").drop("r", "s")


def _open_signatures(docs: DataFrame, open_sets: DataFrame, size: int, bands: Bands) -> DataFrame:
    """Rows (sign, member, root, c) of the open sets, signed anew."""
    texts = _texts_of(docs, open_sets.select("set_id", "doc_id"), size).join(open_sets.select("set_id", "root"), "set_id")

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch["text"], SLICE):
            features, owner = shingles(part, size)
            sign, who = signatures(features, owner, part.count, bands)
            ids, roots = (batch[c].to_numpy()[part.first:part.first + part.count] for c in ("set_id", "root"))
            yield pa.RecordBatch.from_arrays([pa.array(_signed(sign)), pa.array(ids[who]), pa.array(roots[who])], ["sign", "member", "root"])

    return _of_several(arrow_step(texts, step, "sign long, member long, root long"))


def _remaining(rows: DataFrame, open_sets: DataFrame, sets: DataFrame, tried: DataFrame, percent: int, nearest: int | None) -> DataFrame:
    """Possible pairs that share a signature, lie in different components and weren't tried."""
    few = rows.where(F.col("c") <= FEW).select("sign", "member", "root")
    by_id = few.join(few.select("sign", F.col("member").alias("b"), F.col("root").alias("root_b")), "sign").where("member < b and root <> root_b").select(F.col("member").alias("a"), "b")
    many = rows.where(F.col("c") > FEW).withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")).join(
        open_sets.select(F.col("set_id").alias("member"), "n", "map"), "member")
    pairs = by_id.union(_paired_in_blocks(many, percent, nearest)).distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti")
    return _possible(pairs, sets, percent)


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents connected by ``100 * intersection >= percent * union`` of shingle sets.

    ``docs`` has doc_id and text; other columns are ignored. Words are lower-cased (A-Z) runs
    without white space, a shingle is ``size`` words, a shorter text is one shingle as a whole.
    Returns one row per row of ``docs``: doc_id, n_shingles, component_id (the smallest
    doc_id of the group).

    Null and empty texts have no shingles and are linked with nothing. Repeated rows give
    repeated rows in the same group. A row whose doc_id is null takes part like any other,
    but never names its group unless no member has an id. No rows give no rows. Equal sets
    are recognised by a 64-bit hash of their shingles and size, links between different sets
    by their words.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bands = Bands(percent)
    spark = docs.sparkSession
    with small_batches(spark):
        members = written(_sets(docs, size), "sets")
        sets = members.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("map").alias("map"))
        sets = written(sets, "distinct-sets")
        tried = written(_star_pairs(_signed_sets(docs, size, bands)), "candidates")
        release(spark)
        likely = written(_possible(tried, sets, percent), "possible")
        release(spark)
        links = written(_verified(likely, docs, size, percent), "links")
        release(spark)
        # First the nearest partners, which joins most of a group of near copies, then all that are left.
        # Components only grow and only pairs of open sets are tried, so the second turn's shared
        # signatures are among those of the first.
        shared = None
        for nearest in (NEAREST, None):
            open_sets = _owned(sets, tried, links)
            if shared is None:
                found = _open_signatures(docs, open_sets, size, bands)
            else:
                found = _of_several(shared.select("sign", "member").join(open_sets.select(F.col("set_id").alias("member"), "root"), "member"))
            shared = written(found, "mixed")
            release(spark)
            more = written(_remaining(shared, open_sets, sets, tried, percent, nearest), "possible")
            release(spark)
            links = written(links.union(_verified(more, docs, size, percent)), "links")
            release(spark)
            tried = tried.select("a", "b").union(more.select("a", "b"))
        roots = components(links)
    named = sets.select("set_id", "doc_id").join(roots, F.col("set_id") == F.col("node"))
    names = named.groupBy("root").agg(F.min("doc_id").alias("name"))
    grouped = named.select("set_id", "root").join(names, "root").select("set_id", "name")
    single = sets.join(grouped, "set_id", "left").select("set_id", F.coalesce("name", "doc_id").alias("name"))
    return members.select("doc_id", "set_id", F.col("n").alias("n_shingles")).join(single, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("name", "doc_id").alias("component_id"))
