"""Language identification by prediction by partial matching (operator 10).

Per language a byte context tree of variable order (up to ORDER bytes) is
counted. A byte costs, in its longest known context, -log2 of its share there;
if the context has never seen it, the escape probability is charged and the
next shorter context asked, down to a uniform byte (escape estimate: distinct
followers over total plus distinct). Statistics are frozen after training, so a
text's code length under a language is a sum of table entries and independent
of batch or order. The language with the least code length wins (ties: the
lesser name); the score is the posterior of the winner under equal priors.

Training counts ORDER + 1 byte sequences per language in Spark, on a bounded
sample of rows: of each language the first ``PER_LANG`` documents by hash of
doc_id, as far as they fit into ``LANG_BYTES`` together (the larger ones come
last; a document that does not fit is passed over, none is cut). All languages
are learned, with every context seen ``MIN_CONTEXT`` times. The costs of one
group of languages are frozen into one array over (context, byte, language);
groups are formed so that this array stays below ``MODEL_BYTES``, unless a
single language is larger. Scoring is one pass over all whole texts for each
group, vectorised over batches, without a shuffle; with several groups the
winners of the groups are compared by row.

Texts are lower-cased; digits count as 0 and white space as a blank.

Defined cases: text that is null or has no letter is `und` with score 0.0, as is
everything if nothing could be learned; a null doc_id is not held out and not
learned from; repeated rows are scored each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import join_few, stored, table, text_hash
from tablekit.llm.compress_quality import fold

ORDER = 3
#: Bounds on the labelled rows that a language is learned from.
PER_LANG, LANG_BYTES = 400, 4 << 20
MIN_CONTEXT = 4
#: Size of the cost array that one pass over the texts works with.
MODEL_BYTES = 128 << 20
FOLDS, HELD_OUT = 4, 2
#: Code lengths are whole multiples of a bit over this.
UNITS = 1024
CHUNK = 1 << 20
_FOLDED = bytes.maketrans(b"123456789\t\n\x0b\x0c\r", b"000000000     ")


def normal_bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(_FOLDED)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def sequence_codes(data: bytes) -> np.ndarray:
    """Every byte with its ORDER predecessors (blanks before the start), as one integer."""
    b = np.frombuffer(b" " * ORDER + data, np.uint8).astype(np.int64)
    n = len(data)
    code = b[:n]
    for j in range(1, ORDER + 1):
        code = (code << 8) | b[j:j + n]
    return code


def sequence_counts(docs: DataFrame, per_lang: int = PER_LANG, lang_bytes: int = LANG_BYTES) -> DataFrame:
    """(lang, context, byte, c) over the training sample."""
    may = (docs.where("doc_id is not null and lang is not null and text is not null")
           .where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
           .select("doc_id", "lang", text_hash(F.col("text")).alias("th"), F.octet_length("text").cast("long").alias("size")))
    langs = may.groupBy("lang").agg(F.count("*").alias("n"))
    # the first by hash lie below a hash that four times as many documents reach,
    # so the ranking sees about 4 x per_lang rows a language however many there are
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    low = may.join(langs, "lang").where(place < F.lit(4.0 * per_lang * (1 << 30)) / F.col("n"))
    first = Window.partitionBy("lang").orderBy(place, "doc_id", "th")
    fits = Window.partitionBy("lang").orderBy("large", "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    few = (low.select("doc_id", "th", "lang", "size").distinct()              # rows equal in id and text are one
           .withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_lang)
           .withColumn("large", F.col("size") > lang_bytes // 16)
           .withColumn("sum", F.sum("size").over(fits)).where(F.col("sum") <= lang_bytes)
           .select("doc_id", "th", F.col("lang").alias("its")))
    few = stored(few, "lang_sample")
    texts = join_few(docs.select("doc_id", "lang", "text").withColumn("th", text_hash(F.col("text"))), few,
                     ["doc_id", "th"], few.count()).where("lang = its")

    def count(batches):
        for batch in batches:
            rows = {}
            for lang, text in zip(batch.column("its").to_pylist(), batch.column("text").to_pylist()):
                rows.setdefault(lang, []).append(sequence_codes(normal_bytes(text)))
            for lang, codes in rows.items():
                code, c = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(code), pa.string()), pa.array(code >> 8), pa.array(code & 255),
                     pa.array(c)], names=["lang", "context", "byte", "c"])

    return (texts.select("its", "text").mapInArrow(count, "lang string, context long, byte long, c long")
            .groupBy("lang", "context", "byte").agg(F.sum("c").alias("c")))


class CodeLengths:
    """Frozen costs: ``states`` maps a context of ORDER symbols to its state,
    ``costs[state * n_symbols + symbol]`` has one cost a language."""

    def __init__(self, langs: list[str], symbol: np.ndarray, states: np.ndarray, costs: np.ndarray):
        self.langs, self.symbol, self.states, self.costs = langs, symbol, states, costs
        self.n_symbols = int(symbol.max()) + 1 if len(langs) else 0

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text (rows) under each language, in 1/UNITS bit."""
        total = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
        pad = b" " * ORDER
        held, size = [], 0
        for k, text in enumerate(texts):
            for i in range(0, len(text), CHUNK):       # a long text in pieces that overlap by a context
                lead = pad if i == 0 else text[i - ORDER:i]
                held.append((k, lead + text[i:i + CHUNK]))
                size += len(held[-1][1])
                if size >= CHUNK:
                    self._add(held, total)
                    held, size = [], 0
        if held:
            self._add(held, total)
        return total

    def _add(self, held, total) -> None:
        a = self.n_symbols
        s = self.symbol[np.frombuffer(b"".join(x for _, x in held), np.uint8)]
        n = len(s) - ORDER
        code = s[:n].astype(np.int64)
        for j in range(1, ORDER):
            code = code * a + s[j:j + n]
        cost = self.costs[self.states[code].astype(np.int64) * a + s[ORDER:]]
        ends = np.cumsum([len(x) for _, x in held])
        # cost[i] is that of byte i + ORDER: a piece's own bytes, without its lead
        edges = np.stack([np.concatenate([[0], ends[:-1]]), ends - ORDER], axis=1).ravel()
        sums = np.add.reduceat(np.concatenate([cost, np.zeros((1, cost.shape[1]), cost.dtype)]), edges, axis=0,
                               dtype=np.int64)[::2]
        np.add.at(total, [k for k, _ in held], sums)


def freeze(rows) -> CodeLengths:
    """The model from (lang, context, byte, c) rows."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return CodeLengths([], np.zeros(256, np.int64), np.zeros(0, np.int32), np.zeros((0, 0), np.int32))
    by = {lang: ([], [], []) for lang in langs}
    for lang, context, byte, c in rows:
        for out, v in zip(by[lang], (context, byte, c)):
            out.append(v)
    seen = np.zeros(256, dtype=bool)
    seen[32] = True
    for context, byte, _ in by.values():
        seen[byte] = True
        for j in range(ORDER):
            seen[(np.array(context, dtype=np.int64) >> (8 * j)) & 255] = True
    symbol = np.where(seen, np.cumsum(seen) - 1, seen.sum()).astype(np.int64)   # the last: any other byte
    a = int(seen.sum()) + 1

    # per language and order: context -> followers' counts
    trees = []
    for context, byte, c in by.values():
        context, byte, c = np.array(context, np.int64), np.array(byte, np.int64), np.array(c, np.int64)
        syms = [symbol[(context >> (8 * j)) & 255] for j in range(ORDER)]        # 0: the byte just before
        orders, code = [], np.zeros(len(c), dtype=np.int64)
        for order in range(ORDER + 1):
            if order:
                code = code + syms[order - 1] * a ** (order - 1)
            orders.append(_followers(code, symbol[byte], c, a, MIN_CONTEXT if order else 1))
        trees.append(orders)

    base = np.full(a, 8.0)
    costs0 = [_cost(t[0][1][0], base) if len(t[0][0]) else base for t in trees]
    table_, index = [np.stack(costs0, axis=1)], {}
    # a state per context that some language knows; each holds every language's cost there
    for order in range(1, ORDER + 1):
        known = np.unique(np.concatenate([t[order][0] for t in trees]))
        now = {}
        where = [dict(zip(t[order][0].tolist(), range(len(t[order][0])))) for t in trees]
        for code in known.tolist():
            shorter = table_[_longest(code % a ** (order - 1), order - 1, a, index)]
            cost = shorter.copy()
            for k, t in enumerate(trees):
                i = where[k].get(code)
                if i is not None:
                    cost[:, k] = _cost(t[order][1][i], shorter[:, k])
            now[code] = len(table_)
            table_.append(cost)
        index[order] = now
    states = np.zeros(a ** ORDER, dtype=np.int32)
    for order in range(1, ORDER + 1):                  # longer contexts last: they win
        grid = states.reshape(a ** (ORDER - order), a ** order)
        for code, state in index[order].items():
            grid[:, code] = state
    return CodeLengths(langs, symbol, states,
                       np.rint(np.stack(table_).reshape(-1, len(langs)) * UNITS).astype(np.int32))


def _longest(code: int, order: int, a: int, index) -> int:
    """State of the longest known suffix of a context."""
    while order:
        state = index[order].get(code)
        if state is not None:
            return state
        order -= 1
        code %= a ** order
    return 0


def _followers(code, byte, c, a: int, least: int):
    """(contexts, counts of each symbol after them), for contexts seen often enough."""
    contexts, at = np.unique(code, return_inverse=True)
    totals = np.bincount(at, weights=c).astype(np.int64)
    often = totals >= least
    place = np.cumsum(often) - 1
    counts = np.zeros((int(often.sum()), a), dtype=np.int64)
    use = often[at]
    np.add.at(counts, (place[at[use]], byte[use]), c[use])
    return contexts[often], counts


def _cost(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits of each symbol in a context, escaping to the shorter one."""
    total, distinct = counts.sum(), np.count_nonzero(counts)
    escape = np.log2((total + distinct) / distinct)
    return np.where(counts > 0, np.log2((total + distinct) / np.maximum(counts, 1)), escape + shorter)


def groups_of(sizes: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Languages (name, contexts) in groups whose cost array has ``most`` bytes at
    most, at 256 symbols; a larger language is a group by itself."""
    out: list[list[str]] = []
    states = 0
    for lang, n in sizes:
        if out and (states + n) * 256 * 4 * (len(out[-1]) + 1) <= most:
            out[-1].append(lang)
            states += n
        else:
            out.append([lang])
            states = n
    return out


def fit(docs: DataFrame, per_lang: int = PER_LANG, lang_bytes: int = LANG_BYTES, model_bytes: int = MODEL_BYTES
        ) -> list[CodeLengths]:
    """The models of all languages, a group each."""
    counts = stored(sequence_counts(docs, per_lang, lang_bytes), "sequence_counts")
    # contexts of every order up to ORDER are suffixes: at most ORDER times those seen
    sizes = (counts.groupBy("lang", "context").agg(F.sum("c").alias("c")).where(F.col("c") >= MIN_CONTEXT)
             .groupBy("lang").agg((F.count("*") * ORDER).alias("n")))
    every = counts.select("lang").distinct().join(sizes, "lang", "left").orderBy("lang").collect()       # a row a language
    models = []
    for group in groups_of([(r.lang, r.n or 0) for r in every], model_bytes):
        rows = counts.where(F.col("lang").isin(group)).orderBy("lang", "context", "byte").toPandas()
        models.append(freeze(list(zip(*(rows[c].tolist() for c in ("lang", "context", "byte", "c"))))))
    return models


FOUND = "doc_id long, k1 long, k2 long, lang_pred string, bits double, others double"


def _winners(docs: DataFrame, model: CodeLengths) -> DataFrame:
    """Each row's best language of one group, its code length in bits, and the sum
    over the group of 2 ** -(bits beyond it)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            pred, bits, others = [None] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            at = [i for i, t in enumerate(texts) if m.langs and has_letter(t)]
            if at:
                all_bits = m.lengths([normal_bytes(texts[i]) for i in at]) / UNITS
                win = all_bits.argmin(axis=1)
                best = all_bits[np.arange(len(at)), win]
                sums = np.exp2(-np.minimum(all_bits - best[:, None], 1000.0)).sum(axis=1)
                for i, w, b, s in zip(at, win.tolist(), best.tolist(), sums.tolist()):
                    pred[i], bits[i], others[i] = m.langs[w], b, s
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array(pred, pa.string()),
                 pa.array(bits, pa.float64()), pa.array(others, pa.float64())],
                names=["doc_id", "k1", "k2", "lang_pred", "bits", "others"])

    return (docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"), "text")
            .mapInArrow(run, FOUND))


def _better(rows: DataFrame, more: DataFrame) -> DataFrame:
    """The winners of two groups compared by row; rows equal in id and text are
    scored alike, so the second side has one row of each."""
    new = more.dropDuplicates(["k1", "k2"]).select("k1", "k2", F.col("lang_pred").alias("its"), F.col("bits").alias("its_bits"),
                                                   F.col("others").alias("its_others"))
    ahead = (F.col("its_bits") < F.col("bits")) | ((F.col("its_bits") == F.col("bits")) & (F.col("its") < F.col("lang_pred")))
    gap = F.least(F.abs(F.col("its_bits") - F.col("bits")), F.lit(1000.0))
    sums = F.when(ahead, F.col("its_others") + F.col("others") * F.pow(F.lit(2.0), -gap)) \
        .otherwise(F.col("others") + F.col("its_others") * F.pow(F.lit(2.0), -gap))
    return (rows.join(new, ["k1", "k2"])
            .select("doc_id", "k1", "k2", F.when(ahead, F.col("its")).otherwise(F.col("lang_pred")).alias("lang_pred"),
                    F.when(ahead, F.col("its_bits")).otherwise(F.col("bits")).alias("bits"), sums.alias("others")))


def identify(docs: DataFrame, models: list[CodeLengths]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    if not models:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    found = _winners(docs, models[0])
    for model in models[1:]:
        found = stored(_better(found, stored(_winners(docs, model), "group_winners")), "winners")
    known = F.col("lang_pred").isNotNull()
    return found.select("doc_id", F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"),
                        F.when(known, 1.0 / F.col("others")).otherwise(0.0).alias("score"))


def op10(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "lang_pred", "score")
