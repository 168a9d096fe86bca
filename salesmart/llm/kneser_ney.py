"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model predicts a text's next byte from the four before it. Bytes need no tokenizer, hold for
every language and keep the number of different n-grams far below that of the text's words. All
trusted texts are counted: tasks count the n-grams of their rows, the counts are summed by n-gram,
and the lower orders' counts (in how many contexts a shorter n-gram ends) come from the distinct
longer ones. Discounts, back-off weights and probabilities follow order by order from joins of
those tables on the n-gram's context and on its suffix. Several models are fitted and cut into shards in the
same steps, their rows told apart by a column: the driver holds plans and threads for each step, not for each model.

Scoring joins counts, not texts, with the finished table. Rows are gathered into blocks of about ``BLOCK_BYTES``
of text, written once (compressed, with all their columns); a block asks for each of its different n-grams
once. The table is cut into shards by the last two context bytes, which every order of a lookup from the
third on shares (the lower orders, at most 131,842 rows, are broadcast), so a shard answers its n-grams alone. A
shard has about ``SHARD_ROWS`` rows, and never more than the 2^24 + 65,792 n-grams after one pair of bytes. Shards are
packed by tasks, copied once for each ``ANSWERS_AT_ONCE`` n-grams asked (salting, so no shard is one task's work) and
meet the questions in a shuffle; the answers meet their blocks in another. No shard, mark or n-gram passes
through the driver, and a task holds one shard or one block. Marks are computed where a shard is packed: the toxic
model's n-grams go there as further rows.

A model of at most ``BROADCAST_ROWS`` rows in all (counted, 52 MB) is broadcast instead, and every task answers its own
questions with the same packed shards: the same sums without writing or moving a text. The shuffle is the way beyond it.

A document's perplexity is the exponential of its mean negative log-probability per byte. The
threshold of a language is a high quantile of the trusted documents' perplexities, all of them, with
a margin that allows for the spread of short texts. A model knows the texts it was trained on too
well, so for the thresholds each half of the trusted texts (by a hash of the text) is scored by a model
of the other half; the documents are scored by the model of both, whose counts are the halves' sums.

A mean hides a few abusive words in a long clean text. A second model of the same kind is therefore
trained on the text that the labels call toxic, and its n-grams that are at least e ** ``MARK`` times
likelier there than by the trusted model are marks, weighted by the log-ratio beyond ``MARK``. A
document goes as well when its marks' weights (the evidence) sum up to more than its limit: a high
quantile of its language's trusted documents by the root of the length, and never less than
``LEAST_EVIDENCE``.

Defined results: a null or empty text has no perplexity and is rejected; a null or unknown language
is judged by the quantile over all trusted documents; repeated rows are judged each by itself, and
a row that the labels name several times is trusted if any label trusts it and none distrusts it;
without trusted text there is no model and nothing is rejected but empty texts; without toxic text
there are no marks; an empty table gives
no rows; a very long text is a block by itself and read whole; a text whose perplexity or evidence equals its limit
is kept; other columns are ignored by ``classify`` and kept by ``keep``, whatever their names (only names that begin
with two underscores are taken by the columns that ``judge`` adds).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.buffers import joined, pieces, texts_in
from salesmart.llm.common import stored

ORDER = 5
SHARD_ROWS = 1_000_000
#: Trusted ids up to this number (8 MB) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
QUANTILE = 0.99
#: Allowance on the quantile's log-perplexity: a factor, and bytes whose square root spreads it.
MARGIN, SPREAD = 0.03, 1.5
#: Log-ratio from which an n-gram is a mark; least limit of the evidence, and by the root of the bytes.
MARK, LEAST_EVIDENCE, LEAST_RATE = 3.0, 8.0, 0.16
BROADCAST_LANGUAGES = 100_000
#: Text of a block, and n-grams that a copy of a shard answers.
BLOCK_BYTES = 1 << 20
ANSWERS_AT_ONCE = 4_000_000
#: Rows of a whole model that are broadcast.
BROADCAST_ROWS = 4_000_000
BYTES_AT_ONCE = 1 << 20
#: Kinds of a shard's rows.
PROBABILITY, BACKOFF, TOXIC = 0, 1, 2
MERGE_AT = 1_000_000


def codes(data: np.ndarray, order: int) -> np.ndarray:
    """For every place the ``order`` bytes that end there as one number (zeros before the start)."""
    out = data.astype(np.int64)
    for k in range(1, order):
        out[k:] |= data[:-k].astype(np.int64) << (8 * k)
    return out


def _places(begin: np.ndarray, lead: int, size: int) -> np.ndarray:
    """Which places of ``joined`` data are bytes of a text."""
    real = np.ones(size, dtype=bool)
    for k in range(1, lead + 1):
        real[begin[:-1] - k] = False
    return real


def ngrams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """code and n (occurrences) of every n-gram of the column ``text``."""
    def run(batches):
        held, size = [], 0

        def merged():
            code = np.concatenate([c for c, _ in held])
            n = np.concatenate([n for _, n in held])
            unique, where = np.unique(code, return_inverse=True)
            return unique, np.bincount(where, weights=n).astype(np.int64)

        for batch in batches:
            for _, part in pieces(batch.column("text"), BYTES_AT_ONCE):
                data, begin = joined(part, order - 1)
                held.append(np.unique(codes(data, order)[_places(begin, order - 1, len(data))],
                                      return_counts=True))
                size += len(held[-1][0])
                if size > MERGE_AT:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > MERGE_AT // 2:
                        yield _counts(*held[0])
                        held, size = [], 0
        if held:
            yield _counts(*merged())

    return (texts.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))


def _counts(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])


def _discounts(tables: dict[int, DataFrame], by: list[str]) -> dict[int, list[Column]]:
    """By order, each model's D1, D2, D3+ from the numbers of n-grams with counts 1 to 4."""
    union = None
    for k, table in tables.items():
        ones = table.groupBy(F.lit(k).alias("k"), *by).agg(*(F.sum((F.col("n") == i).cast("long")) for i in (1, 2, 3, 4)))
        union = ones if union is None else union.union(ones)
    found = {k: [F.lit(None).cast("double")] * 3 for k in tables}
    for k, *model, n1, n2, n3, n4 in union.collect():                 # a row for each order and model
        n = [float(x) for x in (n1, n2, n3, n4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
        mine = F.lit(True)
        for column, value in zip(by, model):
            mine &= F.col(column) == value
        found[k] = [F.when(mine, min(i, max(0.05, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 * i).otherwise(d)
                    for i, d in zip((1, 2, 3), found[k])]
    return found


def _mask(order: int) -> Column:
    return F.lit((1 << 8 * order) - 1).cast("long")


def train(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """The model of the column ``text``; see ``fit``."""
    return fit(stored(ngrams(texts, order), "kn-counts"), order)


def fit(counts: DataFrame, order: int = ORDER, by: str | None = None) -> DataFrame:
    """The model of stored n-gram counts: k (order), code, log_p (of an n-gram of k bytes; null where it only serves as a
    context) and log_backoff (from k + 1 bytes, in the context ``code`` of k bytes). With ``by``, a model of each of that
    column's few values, which the rows begin with."""
    by = [by] if by else []
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        tables[k] = stored(tables[k + 1].groupBy(*by, F.col("code").bitwiseAND(_mask(k)).alias("code"))
                           .agg(F.count("*").alias("n")), "kn-counts")
    discounts = _discounts(tables, by)
    probability = None
    parts = []
    for k in range(1, order + 1):
        d = discounts[k]
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        context = F.shiftright("code", 8)
        sums = stored(tables[k].groupBy(*by, context.alias("context")).agg(
            F.sum("n").alias("total"), F.sum(cut).alias("freed")), "kn-contexts")
        rows = tables[k].withColumn("context", context).join(sums, [*by, "context"])
        rows = rows.withColumn("suffix", F.col("code").bitwiseAND(_mask(k - 1)) if k > 1 else F.lit(0).cast("long"))
        if k > 1:
            rows = rows.join(probability.select(*by, F.col("code").alias("suffix"), F.col("p").alias("lower")), [*by, "suffix"])
        else:
            rows = rows.withColumn("lower", F.lit(1 / 256))
        p = (F.greatest(F.col("n") - cut, F.lit(0.0)) + F.col("freed") * F.col("lower")) / F.col("total")
        probability = stored(rows.select(*by, "code", p.alias("p")), "kn-probabilities")
        parts.append(probability.select(*by, F.lit(k).alias("k"), "code", F.log("p").alias("log_p"),
                                        F.lit(None).cast("double").alias("log_backoff")))
        parts.append(sums.select(*by, F.lit(k - 1).alias("k"), F.col("context").alias("code"),
                                 F.lit(None).cast("double").alias("log_p"),
                                 F.log(F.col("freed") / F.col("total")).alias("log_backoff")))
    union = parts[0]
    for part in parts[1:]:
        union = union.union(part)
    return stored(union.groupBy(*by, "k", "code").agg(F.max("log_p").alias("log_p"),
                                                      F.max("log_backoff").alias("log_backoff")), "kn-model")


class Table:
    """A shard of the model in sorted arrays: probabilities and back-off weights by order, and marks."""

    def __init__(self, *rows: pa.Table):
        kind, k, code, value = (np.concatenate([r.column(c).to_numpy() for r in rows])
                                for c in ("kind", "k", "code", "value"))
        self.probability, self.backoff = ({
            order: self._sorted(code, value, (k == order) & (kind == which))
            for order in np.unique(k).tolist()} for which in (PROBABILITY, BACKOFF))
        self.marks = self._sorted(code, value, kind == TOXIC)

    @staticmethod
    def _sorted(code: np.ndarray, value: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(where)
        at = at[np.argsort(code[at])]
        return code[at], value[at]

    def evidence(self, code: np.ndarray) -> np.ndarray:
        """The marks' weights of n-grams; zero of others."""
        keys, weights = self.marks
        if not len(keys):
            return np.zeros(len(code))
        at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
        return np.where(keys[at] == code, weights[at], 0.0)

    @staticmethod
    def _find(table: dict, order: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes the table has, and the values of those."""
        keys, values = table.get(order, (np.zeros(0, np.int64), np.zeros(0, np.float32)))
        if not len(keys):
            return np.zeros(len(code), bool), values
        at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
        found = keys[at] == code
        return found, values[at[found]]

    def log_p(self, code: np.ndarray, order: int) -> np.ndarray:
        """log-probability of the last byte of each n-gram of ``order`` bytes."""
        out = np.zeros(len(code))
        open_ = np.arange(len(code))
        for k in range(order, 0, -1):
            c = code[open_] & ((1 << 8 * k) - 1)
            found, value = self._find(self.probability, k, c)
            out[open_[found]] += value
            open_, c = open_[~found], c[~found]
            known, value = self._find(self.backoff, k - 1, c >> 8)
            out[open_[known]] += value
        out[open_] += np.log(1 / 256)
        return out


def _shard(context: np.ndarray, shards: int) -> np.ndarray:
    return (context & 0xFFFF) % shards


@dataclass
class Lookup:
    """A model ready for questions: ``rows`` holds one row per shard (its rows packed in ``body``), ``low`` the rows that
    every shard needs."""
    rows: DataFrame
    low: Broadcast
    shards: int
    order: int
    size: int
    shared: list[Broadcast] = field(default_factory=list)

    def close(self) -> None:
        """To be called when nothing will ask any more."""
        for sent in (self.low, *self.shared):
            sent.destroy()


def _pack(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def _unpack(body: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(body.as_buffer()).read_all()


def lookup_of(model: DataFrame, toxic: DataFrame | None = None, shard_rows: int = SHARD_ROWS,
              order: int = ORDER) -> Lookup:
    """The model in shards, with marks where ``toxic`` (a model of toxic text) is given."""
    return lookups_of(model.withColumn("model", F.lit(0)), [0], toxic, shard_rows, order)[0]


def lookups_of(models: DataFrame, numbers: list[int], toxic: DataFrame | None = None, shard_rows: int = SHARD_ROWS,
               order: int = ORDER) -> dict[int, Lookup]:
    """By its number, each model of the column ``model`` in shards of its own; see ``lookup_of``."""
    probability = models.where("log_p is not null")
    backoff = models.where("log_backoff is not null")

    def rows(df, kind, value, context):
        return df.select("model", F.lit(kind).cast("byte").alias("kind"), F.col("k").cast("byte").alias("k"), "code",
                         F.col(value).cast("float").alias("value"), context.bitwiseAND(0xFFFF).alias("pair"))

    # an n-gram's own row goes by its context, its row as a context of the next order by itself
    roles = rows(probability, PROBABILITY, "log_p", F.shiftright("code", 8)).union(
        rows(backoff, BACKOFF, "log_backoff", F.col("code")))
    # contexts of no and of one byte know no pair; these rows are at most 131,842 a model
    short = (F.col("k") <= 1) | ((F.col("k") == 2) & (F.col("kind") == PROBABILITY))
    few = roles.where(short).drop("pair").toArrow()
    low = {m: models.sparkSession.sparkContext.broadcast(few.filter(pc.equal(few.column("model"), m)).drop_columns("model"))
           for m in numbers}
    roles = roles.where(~short)
    if toxic is not None:
        marks = toxic.where((F.col("k") == order) & F.col("log_p").isNotNull())
        roles = roles.union(rows(marks.withColumn("model", F.explode(F.array(*map(F.lit, numbers)))), TOXIC, "log_p",
                                 F.shiftright("code", 8)))
    roles = stored(roles, "kn-roles")
    size = dict.fromkeys(numbers, 0) | {m: n for m, n in roles.groupBy("model").count().collect()}
    shards = {m: max(1, -(-size[m] // shard_rows)) for m in numbers}
    of = F.create_map(*(F.lit(x) for item in shards.items() for x in item))[F.col("model")]
    packed = stored(roles.select("model", (F.col("pair") % of).cast("int").alias("shard"), "kind", "k", "code", "value")
                    .repartition("model", "shard").sortWithinPartitions("model", "shard")
                    .mapInArrow(_packing(low, order), "model int, shard int, body binary"), "kn-shards")
    return {m: Lookup(packed.where(F.col("model") == m).drop("model"), low[m], shards[m], order, size[m]) for m in numbers}


def _packing(low: dict[int, Broadcast], order: int):
    def packed(model: int, shard: int, held: list) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).drop_columns(["model", "shard"])
        is_toxic = pc.equal(rows.column("kind"), TOXIC)
        known, toxic = rows.filter(pc.invert(is_toxic)), rows.filter(is_toxic)
        ratio = toxic.column("value").to_numpy() - Table(low[model].value, known).log_p(toxic.column("code").to_numpy(), order)
        marks = toxic.set_column(3, "value", pa.array((ratio - MARK).astype(np.float32))).filter(pa.array(ratio > MARK))
        body = _pack(pa.concat_tables([known, marks.cast(known.schema)]).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([shard], pa.int32()),
                                           pa.array([body], pa.binary())], names=["model", "shard", "body"])

    def run(batches):
        now, held = None, []
        for batch in batches:
            model, shard = (batch.column(c).to_numpy() for c in ("model", "shard"))
            edge = np.r_[0, np.flatnonzero((np.diff(model) != 0) | (np.diff(shard) != 0)) + 1, len(shard)].tolist()
            for a, b in zip(edge[:-1], edge[1:]):
                if b > a:
                    if held and (model[a], shard[a]) != now:
                        yield packed(*now, held)
                        held = []
                    now = int(model[a]), int(shard[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield packed(*now, held)
    return run


def _grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's texts: the different n-grams, which of them every byte ends, which places of the joined
    texts are bytes of them, and where each text begins and ends there."""
    data, begin = joined(texts, order - 1)
    real = _places(begin, order - 1, len(data))
    unique, which = np.unique(codes(data, order)[real], return_inverse=True)
    end = np.r_[begin[1:-1] - (order - 1), len(data)] if len(texts) else begin[:0]
    return unique, which, real, begin[:-1], end


#: shard is -1 in the row that carries a block's rows; ``n`` n-grams are asked from any other.
BLOCKS = "block long, shard int, n long, codes binary, body binary"
ANSWERS = "block long, shard int, value binary, evidence binary, body binary"
LAST = (1 << 31) - 1


def _blocks(batches, text_col: str) -> Iterator[pa.RecordBatch]:
    """Rows in lots of about ``BLOCK_BYTES`` of text; a longer text is alone."""
    held, size = [], 0
    for batch in batches:
        for first, part in pieces(texts_in(batch, text_col), BLOCK_BYTES):
            if held and size + part.nbytes > BLOCK_BYTES:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
            held.append(batch.slice(first, len(part)))
            size += part.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _asking(text_col: str, shards: int, order: int):
    def run(batches):
        task = TaskContext.get().partitionId() << 32
        for number, rows in enumerate(_blocks(batches, text_col)):
            unique = _grams(texts_in(rows, text_col), order)[0]
            shard = _shard(unique >> 8, shards)
            asked = {int(s): unique[shard == s] for s in np.unique(shard)}
            delta = [pa.compress(np.diff(c, prepend=0).tobytes(), "zstd", asbytes=True) for c in asked.values()]
            yield pa.RecordBatch.from_arrays([
                pa.array([task + number] * (len(asked) + 1), pa.int64()), pa.array([-1, *asked], pa.int32()),
                pa.array([0, *map(len, asked.values())], pa.int64()), pa.array([None, *delta], pa.binary()),
                pa.array([_pack(rows)] + [None] * len(asked), pa.binary())], names=["block", "shard", "n", "codes", "body"])
    return run


def _answering(low: Broadcast, order: int):
    def run(batches):
        now = known = None
        for batch in batches:
            block, shard, salt, n = (batch.column(c).to_pylist() for c in ("block", "shard", "salt", "n"))
            for i in range(batch.num_rows):
                if (shard[i], salt[i]) != now:
                    now, known = (shard[i], salt[i]), None
                if block[i] < 0:
                    known = Table(low.value, _unpack(batch.column("data")[i]))
                    continue
                known = known or Table(low.value)                     # a shard without rows
                code = np.cumsum(np.frombuffer(pa.decompress(batch.column("data")[i].as_buffer(), 8 * n[i], "zstd"), np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array([block[i]], pa.int64()), pa.array([shard[i]], pa.int32()),
                    *(pa.array([v.astype(np.float32).tobytes()], pa.binary())
                      for v in (known.log_p(code, order), known.evidence(code))), pa.array([None], pa.binary())],
                    names=["block", "shard", "value", "evidence", "body"])
    return run


def score(docs: DataFrame, lookup: Lookup, text_col: str = "text", columns: list[str] | None = None,
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs``, all rows and ``columns`` (all), with ``__n_bytes``, ``__log_prob`` and ``__evidence`` of the text."""
    kept = docs.select(*(docs.columns if columns is None else columns))
    schema = kept.withColumns({"__n_bytes": F.lit(0).cast("long"), "__log_prob": F.lit(0.0), "__evidence": F.lit(0.0)}).schema
    if lookup.size <= broadcast_rows:
        packed = lookup.rows.toArrow()          # at most ``broadcast_rows`` rows of 13 bytes
        shared = docs.sparkSession.sparkContext.broadcast(dict(zip(packed.column("shard").to_pylist(),
                                                                   packed.column("body").to_pylist())))
        lookup.shared.append(shared)
        return docs.mapInArrow(_answered(shared, lookup.low, text_col, kept.columns, lookup.shards, lookup.order), schema)
    blocks = stored(docs.mapInArrow(_asking(text_col, lookup.shards, lookup.order), BLOCKS), "kn-blocks")
    asked = blocks.where("shard >= 0")
    copies = max(1, -(-(asked.agg(F.sum("n")).first()[0] or 0) // (lookup.shards * ANSWERS_AT_ONCE)))
    salt = F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int").alias("salt")
    # a shard's copies come before the questions to them
    tables = lookup.rows.select(F.lit(-1).cast("long").alias("block"), "shard", F.explode(
        F.sequence(F.lit(0), F.lit(copies - 1))).alias("salt"), F.lit(0).cast("long").alias("n"), F.col("body").alias("data"))
    answers = (tables.union(asked.select("block", "shard", salt, "n", F.col("codes").alias("data")))
               .repartition("shard", "salt").sortWithinPartitions("shard", "salt", "block")
               .mapInArrow(_answering(lookup.low, lookup.order), ANSWERS))
    nothing = F.lit(None).cast("binary")
    bodies = blocks.where("shard < 0").select("block", F.lit(LAST).alias("shard"), nothing, nothing, "body")
    return (answers.union(bodies).repartition("block").sortWithinPartitions("block", "shard")
            .mapInArrow(_gathering(text_col, kept.columns, lookup.shards, lookup.order), schema))


def _sums(value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return np.array([value[a:b].sum() for a, b in zip(begin.tolist(), end.tolist())])


def _scored(rows: pa.RecordBatch, answer, text_col: str, columns: list[str], shards: int, order: int) -> pa.RecordBatch:
    """A block's rows with their sums; ``answer`` gives a shard's values and evidence for its n-grams, or None."""
    unique, which, real, begin, end = _grams(texts_in(rows, text_col), order)
    shard = _shard(unique >> 8, shards)
    of = np.zeros((2, len(unique)))
    for s in np.unique(shard).tolist():
        mine = shard == s
        of[:, mine] = answer(s, unique[mine])
    added = {"__n_bytes": end - begin}
    for name, values in zip(("__log_prob", "__evidence"), of):
        places = np.zeros(len(real))
        places[real] = values[which]
        added[name] = _sums(places, begin, end)
    return pa.RecordBatch.from_arrays([*(rows.column(c) for c in columns), *map(pa.array, added.values())],
                                      names=[*columns, *added])


def _answered(shared: Broadcast, low: Broadcast, text_col: str, columns: list[str], shards: int, order: int):
    def run(batches):
        tables = {s: Table(low.value, _unpack(pa.scalar(body))) for s, body in shared.value.items()}
        none = Table(low.value)                                       # a shard without rows

        def answer(s, code):
            table = tables.get(s, none)
            return [table.log_p(code, order), table.evidence(code)]
        for rows in _blocks(batches, text_col):
            yield _scored(rows, answer, text_col, columns, shards, order)
    return run


def _gathering(text_col: str, columns: list[str], shards: int, order: int):
    def run(batches):
        now, answers = None, {}
        for batch in batches:
            for i, (block, shard) in enumerate(zip(batch.column("block").to_pylist(), batch.column("shard").to_pylist())):
                if block != now:
                    now, answers = block, {}
                if shard < LAST:
                    answers[shard] = [np.frombuffer(batch.column(c)[i].as_buffer(), np.float32) for c in ("value", "evidence")]
                else:
                    for rows in _unpack(batch.column("body")[i]).to_batches():
                        yield _scored(rows, lambda s, _: answers[s], text_col, columns, shards, order)
    return run


def labelled_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """labelled_id and ``toxic``: false for ids that the labels call good and not toxic, true for those
    that any label calls toxic."""
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("labelled_id"))
            .agg(F.min(F.coalesce(good, F.lit(False))).alias("good"), F.max(toxic).alias("toxic"))
            .where("good or toxic").select("labelled_id", "toxic"))


def _log_perplexity() -> Column:
    return F.when(F.col("__n_bytes") > 0, -F.col("__log_prob") / F.col("__n_bytes"))


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, lang, text and any others; only ``columns`` are carried on) with ``__n_bytes``,
    ``__log_perplexity``, ``__threshold``, ``__evidence``, ``__evidence_limit`` and ``__kept``."""
    ids = stored(labelled_ids(labels), "kn-labelled")

    def texts(toxic: bool) -> DataFrame:
        some = ids.where(F.col("toxic") == toxic)
        some = F.broadcast(some) if some.count() <= BROADCAST_IDS else some
        return (docs.select("doc_id", "lang", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                .join(some, F.col("doc_id").cast("long") == F.col("labelled_id"), "left_semi").select("lang", "text"))

    trusted = texts(False)
    halves = [trusted.where(F.pmod(F.xxhash64("text"), F.lit(2)) == h) for h in (0, 1)]
    toxic = texts(True)
    half_models, whole, toxic_model = (0, 1), 2, 3

    def numbered(df: DataFrame, number: int) -> DataFrame:
        return df.select(F.lit(number).alias("model"), "code", "n")

    counts = numbered(ngrams(halves[0].select("text")), half_models[0])
    for number, some in ((half_models[1], halves[1]), (toxic_model, toxic)):
        counts = counts.union(numbered(ngrams(some.select("text")), number))
    counts = stored(counts, "kn-counts")
    both = counts.where(F.col("model").isin(*half_models)).groupBy("code").agg(F.sum("n").alias("n"))
    models = fit(counts.union(stored(numbered(both, whole), "kn-counts")), by="model")
    lookups = lookups_of(models.where(F.col("model") != toxic_model), [*half_models, whole],
                         models.where(F.col("model") == toxic_model).drop("model"))

    spread = SPREAD / F.sqrt(F.greatest(F.col("__n_bytes"), F.lit(1)))
    root = F.sqrt(F.col("__n_bytes"))
    scores = [score(half, lookups[other], columns=["lang"]).where("__n_bytes > 0").select(
        "lang", (_log_perplexity() - spread).alias("x"), (F.col("__evidence") / root).alias("e"))
        for half, other in zip(halves, reversed(half_models))]
    levels = stored(scores[0].union(scores[1]), "kn-trusted-scores")
    for number in half_models:
        lookups[number].close()                 # the scores are written, nothing asks any more
    lookup = lookups[whole]
    level, rate = (F.percentile_approx(c, F.lit(quantile), F.lit(10_000)) for c in ("x", "e"))
    # no longer than the languages, and one row
    by_lang = stored(levels.where("lang is not null").groupBy(F.col("lang").cast("string").alias("__lang"))
                     .agg(level.alias("__level"), rate.alias("__rate")), "kn-levels")
    by_lang = F.broadcast(by_lang) if by_lang.count() <= BROADCAST_LANGUAGES else by_lang
    overall, overall_rate = levels.agg(level, rate).first()
    if columns is None:
        scored = score(docs, lookup)
    else:
        scored = score(docs.select(*dict.fromkeys([*columns, "lang", "text"])), lookup,
                       columns=list(dict.fromkeys([*columns, "lang"])))
    limit = F.coalesce("__level", F.lit(overall).cast("double")) + MARGIN + spread
    evidence = F.greatest(F.lit(LEAST_EVIDENCE), root * F.greatest(
        F.lit(LEAST_RATE), F.coalesce("__rate", F.lit(overall_rate).cast("double"))))
    # without trusted text there is no level: nothing to compare with
    kept = F.coalesce(F.col("__log_perplexity") <= F.col("__threshold"), F.lit(True)) & (
        F.col("__threshold").isNull() | (F.col("__evidence") <= F.col("__evidence_limit")))
    return (scored.join(by_lang, F.col("lang").cast("string") == F.col("__lang"), "left")
            .withColumns({"__log_perplexity": _log_perplexity(), "__threshold": limit, "__evidence_limit": evidence})
            .withColumn("__kept", (F.col("__n_bytes") > 0) & kept))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_bytes, log_perplexity, threshold, kept, evidence, evidence_limit of every row."""
    out = judge(docs, labels, quantile, ["doc_id"])
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", *(
        F.col(f"__{c}").alias(c) for c in ("n_bytes", "log_perplexity", "threshold", "kept", "evidence", "evidence_limit")))


def keep(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The accepted rows of ``docs`` with all their columns."""
    return judge(docs, labels, quantile).where("__kept").select(*docs.columns)
