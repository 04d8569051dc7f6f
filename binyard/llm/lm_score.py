"""Operator 2: language-model scoring with sharded Elias-Fano n-gram tries.

Model: bigrams with discounted counts, interpolated with a discounted unigram
distribution over the training vocabulary and one unknown class.  Nothing of
the model is collected or broadcast but what a thousand hot words sum up to; it
grows with the corpus and lives in shards.

  1. Texts are taken in blocks.  A block's distinct words and distinct (word,
     successor) pairs, with their counts in training documents, go to shards by
     the word's hash.  A common word appears once a block, however often it
     occurs.  The successors of hot words (a thousandth of all tokens or more,
     so a thousand words at most) are dealt out by the pair's hash instead.
  2. A shard sums the counts.  Summed over all shards, the counts of counts
     give the discounts, and the hot words their totals.
  3. Each shard's trie is built with them (``ngram_trie.Trie``): smoothed
     probabilities and back-off weights in a byte each.  Its levels are one
     file in the shared folder.
  4. What the blocks asked is answered from the files, mapped into memory where
     the folder is a local one (else read whole, a shard at a time), and goes
     back to the blocks, which score their texts.

Blocks and shards both grow with the square root of the corpus, up to a bound
of memory, so the messages between them, one for each block and shard that have
words in common, grow in proportion to the corpus; beyond the bound they can be
no more than the blocks' distinct words.

``docs`` is read twice and has to give the same rows in the same partitions
both times, as a table does; a block that changed raises an error.  Store a
frame that comes out of a shuffle first.

Edge cases: null and blank texts have one token, the end; a null id is neither
held out nor trained on; repeated rows count as often as they come; with no
training document every token is unknown and scores are 0; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.llm import kernel
from binyard.llm.common import crc_mod, shared_dir, ship, staged
from binyard.llm.ngram_trie import SUCCESSOR_BITS, SUCCESSOR_MASK, EliasFano, Trie, discounts_of, restore

#: Text of a block and tokens of a shard, for a corpus of up to BASE_TOKENS
#: tokens; and what they grow to at most.
BLOCK_BYTES, MOST_BLOCK = 5 << 18, 4 << 20
SHARD_TOKENS, MOST_SHARD = 500_000, 2_000_000
BASE_TOKENS = 25_000_000
#: A word with this share of all tokens or more is hot.
HOT_SHARE = 1 / 1000

_U = np.uint64
#: Hashes of the two marks; a word's hash equals one with probability 2**-63.
BEGIN, END = _U(0xB5AD4ECEDA1CE2A9), _U(0x6C8E9CF570932BD5)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a block, each text closed by END, and the
    number of tokens of each text."""
    out, counts = [], []
    for a, b in kernel.pieces(offsets):
        off = offsets[a : b + 1] - offsets[a]
        _, _, row, h = kernel.words(data[offsets[a] : offsets[b]], off)
        n = np.bincount(row, minlength=b - a)
        out.append(np.insert(h, np.cumsum(n), END))
        counts.append(n + 1)
    if not out:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(counts)


class Block:
    """The distinct words and pairs of a block of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        tokens, self.counts = _tokens(data, offsets)
        self.first = np.concatenate(([0], np.cumsum(self.counts)[:-1])).astype(np.int64)
        both = np.concatenate((tokens, np.array([BEGIN], dtype=_U)))
        self.word, inverse = np.unique(both, return_inverse=True)
        self.token, begin = inverse[:-1], inverse[-1]
        before = np.empty(len(tokens), dtype=np.int64)
        before[1:] = self.token[:-1]
        before[self.first] = begin
        self.begin = begin
        key = (before.astype(_U) << _U(SUCCESSOR_BITS)) | (tokens >> _U(64 - SUCCESSOR_BITS))
        self.pair, self.pair_of = np.unique(key, return_inverse=True)
        self.context = (self.pair >> _U(SUCCESSOR_BITS)).astype(np.int64)

    def training(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words (BEGIN: texts) and pairs in the training texts."""
        use = np.repeat(train, self.counts)
        word = np.bincount(self.token[use], minlength=len(self.word))
        word[self.begin] += int(train.sum())
        return word, np.bincount(self.pair_of[use], minlength=len(self.pair))

    def routes(self, shards: int, hot: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(shard, places of its words, which of them are at home, places of its pairs)."""
        home = (self.word % _U(shards)).astype(np.int64)
        is_hot = np.isin(self.word, hot)
        to = home[self.context]
        spread = np.flatnonzero(is_hot[self.context])
        if len(spread):
            to[spread] = (kernel.mix(self.word[self.context[spread]] + (self.pair[spread] & _U(SUCCESSOR_MASK)) * _U(0x9E3779B97F4A7C15)) % _U(shards)).astype(np.int64)
        words, pairs = np.argsort(home, kind="stable"), np.argsort(to, kind="stable")
        cut_w = np.searchsorted(home[words], np.arange(shards + 1))
        cut_p = np.searchsorted(to[pairs], np.arange(shards + 1))
        for s in range(shards):
            own, sent = words[cut_w[s] : cut_w[s + 1]], pairs[cut_p[s] : cut_p[s + 1]]
            away = np.unique(self.context[sent[is_hot[self.context[sent]]]])
            at = np.union1d(own, away) if len(away) else own
            if len(at):
                yield s, at, home[at] == s, sent


def _small(x: np.ndarray) -> tuple[bytes, bytes]:
    """Mostly small counts: a byte each, the large ones apart."""
    big = np.flatnonzero(x >= 255)
    extra = np.stack((big, x[big]), axis=1).astype(np.int64)
    return np.minimum(x, 255).astype(np.uint8).tobytes(), extra.tobytes()


def _large(small: bytes, extra: bytes) -> np.ndarray:
    x = np.frombuffer(small, dtype=np.uint8).astype(np.int64)
    big = np.frombuffer(extra, dtype=np.int64).reshape(-1, 2)
    x[big[:, 0]] = big[:, 1]
    return x


def _five(x: np.ndarray) -> bytes:
    """Successors' hashes, five bytes each: the low four, then the high ones."""
    return x.astype(np.uint32).tobytes() + (x >> _U(32)).astype(np.uint8).tobytes()


def _of_five(data: bytes) -> np.ndarray:
    n = len(data) // 5
    return np.frombuffer(data, np.uint32, n).astype(_U) | np.frombuffer(data, np.uint8, n, 4 * n).astype(_U) << _U(32)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Table]]:
    """(block, rows): rows in order, cut at ``most`` bytes of text, whatever
    the batches are."""
    part, n, held, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        t = pa.Table.from_batches([batch])
        _, offsets = kernel.buffers(t.column("text"))
        a = 0
        for r in range(t.num_rows):
            size += int(offsets[r + 1] - offsets[r]) + 64
            if size >= most:
                held.append(t.slice(a, r + 1 - a))
                yield (part << 32) + n, pa.concat_tables(held)
                held, size, a, n = [], 0, r + 1, n + 1
        if a < t.num_rows:
            held.append(t.slice(a))
    if held:
        yield (part << 32) + n, pa.concat_tables(held)


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of a partition, and the words that are hot in it: any word
    that is hot in the whole is hot in some partition."""
    total, n = {}, 0
    for _, t in _blocks(batches, BLOCK_BYTES):
        data, offsets = kernel.buffers(t.column("text"))
        tokens, _ = _tokens(data, offsets)
        word, count = np.unique(tokens, return_counts=True)
        n += len(tokens)
        at = count >= len(tokens) * HOT_SHARE
        for w, c in zip(word[at].view(np.int64).tolist(), count[at].tolist(), strict=True):
            total[w] = total.get(w, 0) + c
    yield pa.RecordBatch.from_arrays([pa.array([None, *total], pa.int64()), pa.array([n, *total.values()], pa.int64())], names=["word", "n"])


_ASK = "shard int, block long, words binary, counts binary, counts_x binary, spread binary, spread_x binary, next binary, pairs binary, pairs_x binary"
_TELL = "block long, shard int, counts binary, backoff binary, codes binary"
#: Kind 0, a shard's sums: words, counts, pairs, pair_n, pair_x; the counts of
#: counts; (word, followed, successors of count 1, 2, 3 and more) of hot words.
#: Kind 1, a block's questions: words, spread, spread_x, next.
_SUMS = "kind int, shard int, block long, words binary, spread binary, spread_x binary, next binary, pair_n binary, pair_x binary, totals array<long>, hot array<struct<word: long, n: long, n1: long, n2: long, n3: long>>"


def _ask(shards: int, hot: np.ndarray, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, t in _blocks(batches, most):
            data, offsets = kernel.buffers(t.column("text"))
            b = Block(data, offsets)
            word_n, pair_n = b.training(t.column("train").combine_chunks().to_numpy(zero_copy_only=False).astype(bool))
            rows: dict[str, list] = {x.split()[0]: [] for x in _ASK.split(", ")}
            for s, at, home, sent in b.routes(shards, hot):
                counts = _small(np.where(home, word_n[at], 0))
                spread = _small(np.bincount(np.searchsorted(at, b.context[sent]), minlength=len(at)))
                pairs = _small(pair_n[sent])
                values = (s, block, EliasFano.encode(b.word[at]).tobytes(), *counts, *spread, _five(b.pair[sent] & _U(SUCCESSOR_MASK)), *pairs)
                for name, value in zip(rows, values, strict=True):
                    rows[name].append(value)
            kinds = {"shard": pa.int32(), "block": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in rows.items()], names=list(rows))
    return run


def _sum(hot: np.ndarray):
    """A shard's sums over all blocks, and the blocks' questions as they came."""
    def run(table: pa.Table) -> pa.Table:
        asked = []
        for r in table.to_pylist():
            word, spread = EliasFano.view(r["words"]).values(), _large(r["spread"], r["spread_x"])
            asked.append((word, np.repeat(np.arange(len(word)), spread), _of_five(r["next"]), _large(r["counts"], r["counts_x"]), _large(r["pairs"], r["pairs_x"])))
        shard = table.column("shard")[0].as_py()
        # only what training saw makes the model
        seen, count = [], []
        for word, context, _, n, pairs in asked:
            use = n > 0
            use[context[pairs > 0]] = True
            seen.append(word[use])
            count.append(n[use])
        word, inverse = np.unique(np.concatenate(seen), return_inverse=True)
        count = np.bincount(inverse, weights=np.concatenate(count), minlength=len(word)).astype(np.int64)
        keys, pair_n = [], []
        for own, context, following, _, pairs in asked:
            use = pairs > 0
            keys.append((np.searchsorted(word, own[context[use]]).astype(_U) << _U(SUCCESSOR_BITS)) | following[use])
            pair_n.append(pairs[use])
        del asked, seen
        pair, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        pair_n = np.bincount(inverse, weights=np.concatenate(pair_n), minlength=len(pair)).astype(np.int64)
        del keys, inverse
        context = (pair >> _U(SUCCESSOR_BITS)).astype(np.int64)
        own = count[(word != BEGIN) & (count > 0)]
        totals = [int(own.sum()), len(own), *(int((own == c).sum()) for c in (1, 2, 3, 4)), *(int((pair_n == c).sum()) for c in (1, 2, 3, 4))]
        loud = []
        for i in np.flatnonzero(np.isin(word, hot)).tolist():
            n = pair_n[np.searchsorted(context, i) : np.searchsorted(context, i + 1)]
            loud.append({"word": int(word[i : i + 1].view(np.int64)[0]), "n": int(n.sum()), **{f"n{c}": int((np.minimum(n, 3) == c).sum()) for c in (1, 2, 3)}})
        rows = table.num_rows
        sums = [[0], [shard], [None], [EliasFano.encode(word).tobytes()], *([x] for x in _small(count)), [EliasFano.encode(pair).tobytes()],
                *([x] for x in _small(pair_n)), [totals], [loud]]
        kept = [[1] * rows, [shard] * rows, *(table.column(c).to_pylist() for c in ("block", "words", "spread", "spread_x", "next")),
                [None] * rows, [None] * rows, [None] * rows, [None] * rows]
        five = pa.list_(pa.struct([(x, pa.int64()) for x in ("word", "n", "n1", "n2", "n3")]))
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 6, pa.list_(pa.int64()), five]
        names = ["kind", "shard", "block", "words", "spread", "spread_x", "next", "pair_n", "pair_x", "totals", "hot"]
        return pa.table([pa.array(a + b, kind) for a, b, kind in zip(sums, kept, kinds, strict=True)], names=names)
    return run


def _level_file(folder: str, shard: int) -> tuple[files.FileSystem, str]:
    system, path = files.FileSystem.from_uri(folder)
    return system, f"{path}/{shard}.trie"


def _build(folder: str, taken: np.ndarray, whole: dict[int, tuple[int, int, int, int]]):
    """Write each shard's trie; a task that runs again writes the same bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = Trie.build(EliasFano.view(r["words"]).values(), _large(r["spread"], r["spread_x"]), EliasFano.view(r["next"]).values(),
                                  _large(r["pair_n"], r["pair_x"]), taken, whole)
                system, path = _level_file(folder, r["shard"])
                draft = f"{path}.{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as out:
                    out.write(data)
                system.move(draft, path)
                yield pa.RecordBatch.from_arrays([pa.array([len(data)], pa.int64())], names=["bytes"])
    return run


def _open(folder: str, shard: int) -> Trie:
    system, path = _level_file(folder, shard)
    if isinstance(system, files.LocalFileSystem):
        return Trie.view(np.memmap(path, dtype=np.uint8, mode="r"))
    with system.open_input_file(path) as f:
        return Trie.view(f.read_buffer())


def _answer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, Trie] | None = None
        for batch in batches:
            for r in batch.to_pylist():
                if held is None or held[0] != r["shard"]:
                    held = r["shard"], _open(folder, r["shard"])  # a shard's rows stand together
                trie, own = held[1], EliasFano.view(r["words"]).values()
                at = trie.word(own)
                known, place = at >= 0, np.maximum(at, 0)
                tell = lambda x, kind: (np.where(known, x[place], 0) if len(x) else np.zeros(len(own))).astype(kind)  # noqa: B023, E731
                codes = trie.pairs(at, _large(r["spread"], r["spread_x"]), _of_five(r["next"]))
                values = (r["block"], r["shard"], tell(trie.count, np.int64).tobytes(), tell(trie.backoff, np.uint8).tobytes(), codes.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, (pa.int64(), pa.int32(), *[pa.binary()] * 3), strict=True)],
                                                 names=[x.split()[0] for x in _TELL.split(", ")])
    return run


def _score(shards: int, hot: np.ndarray, totals: list[int]):
    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        texts = pa.concat_tables([pa.ipc.open_stream(x.as_py()).read_all() for x in texts.column("rows")])
        data, offsets = kernel.buffers(texts.column("text"))
        b = Block(data, offsets)
        answers = {r["shard"]: r for r in told.to_pylist()}
        count = np.zeros(len(b.word), dtype=np.int64)
        backoff = np.zeros(len(b.word))
        share = np.zeros(len(b.pair))
        n, v, n1, n2 = totals[:4]
        for s, at, home, sent in b.routes(shards, hot):
            r = answers.get(s)
            if r is None or len(r["backoff"]) != len(at) or len(r["codes"]) != len(sent):
                raise RuntimeError("a block of documents changed between two reads of the table")
            count[at[home]] = np.frombuffer(r["counts"], dtype=np.int64)[home]
            # every shard that holds successors of a word knows its back-off
            backoff[at] = np.maximum(backoff[at], restore(np.frombuffer(r["backoff"], dtype=np.uint8)))
            share[sent] = restore(np.frombuffer(r["codes"], dtype=np.uint8))
        d = np.clip(n1 / max(n1 + 2 * n2, 1), 0.1, 0.95)
        unigram = np.where(count > 0, (count - d) / max(n, 1), d * v / max(n, 1)) if n else np.ones(len(b.word))
        # the successor's place: each pair's word is the token where it stands
        last = np.empty(len(b.pair), dtype=np.int64)
        last[b.pair_of] = b.token
        p = np.where(count[b.context] > 0, share + backoff[b.context] * unigram[last], unigram[last])
        base = np.log10((count + 1) / (n + v + 1))
        total = lambda x: np.add.reduceat(x, b.first) if len(b.first) else np.zeros(0)
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": pa.array(b.counts.astype(np.int64)),
            "n_known": pa.array(total((count > 0)[b.token].astype(np.int64)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(b.counts), n, dtype=np.int64)),
            "base_score": pa.array(total(base[b.token])), "score": pa.array(total(np.log10(np.clip(p, 1e-300, 1.0))[b.pair_of]))})
    return run


def _pack(most: int):
    """(block, rows): each block's rows as one compressed Arrow stream, so
    that the shuffle that takes texts to their answers moves little."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, t in _blocks(batches, most):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(t)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "rows"])
    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """``docs``: doc_id, text, train, held_out.  One row each: doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce("train", F.lit(False)).alias("train"), F.coalesce("held_out", F.lit(False)).alias("held_out"))
    heavy = docs.select("text").mapInArrow(_heavy, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    heavy = heavy.persist()
    n = heavy.filter("word is null").agg(F.sum("n")).first()[0] or 0
    # their counts sum to at most n: no more than 1 / HOT_SHARE words
    hot = [r["word"] for r in heavy.filter(F.col("word").isNotNull() & (F.col("n") >= n * HOT_SHARE)).collect()]
    heavy.unpersist()
    hot = np.concatenate((np.array(sorted(hot), dtype=np.int64).view(_U), np.array([BEGIN, END], dtype=_U)))
    grown = math.sqrt(max(1.0, n / BASE_TOKENS))
    block = int(min(BLOCK_BYTES * grown, max(MOST_BLOCK, BLOCK_BYTES)))
    shards = max(1, math.ceil(n / min(SHARD_TOKENS * grown, max(MOST_SHARD, SHARD_TOKENS))))

    asked = docs.select("text", "train").mapInArrow(_ask(shards, hot, block), _ASK)
    sums, _ = staged(asked.groupBy("shard").applyInArrow(_sum(hot), _SUMS), "sums", "zstd")
    model = sums.filter("kind = 0")
    row = model.agg(*[F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(10)]).first()
    totals = [int(x or 0) for x in row]
    loud = model.select(F.explode("hot").alias("h")).select("h.*").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "n1", "n2", "n3")])
    whole = {int(np.int64(r["word"]).view(_U)): (r["n"], r["n1"], r["n2"], r["n3"]) for r in loud.collect()}  # one row a hot word
    folder = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    where, path = files.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    model.select("shard", "words", "spread", "spread_x", "next", "pair_n", "pair_x").mapInArrow(
        _build(folder, discounts_of(*totals[6:]), whole), "bytes long").agg(F.sum("bytes")).first()
    told = sums.filter("kind = 1").select("block", "shard", "words", "spread", "spread_x", "next").mapInArrow(_answer(folder), _TELL)
    texts = docs.select("doc_id", "text", "held_out").mapInArrow(_pack(block), "block long, rows binary")
    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _score(shards, hot, totals),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op2(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rest = crc_mod(F.col("doc_id"), 7)
    return score_documents(docs.select("doc_id", "text", (rest != 2).alias("train"), (rest == 2).alias("held_out")))
