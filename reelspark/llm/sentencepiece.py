"""SentencePiece encoding and decoding over a lattice of pieces."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelspark.llm.text import only
from reelspark.session import batches_of, materialise

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
FREQUENT_WORDS = 1 << 17
CACHED_CHARACTERS = 1 << 20
LONGEST_TOGETHER = 100
_BYTES_AT_ONCE = 1 << 21
_WORDS_AT_ONCE = 300_000
_TOKENS_AT_ONCE = 1 << 20
_UNKNOWN_PENALTY = 10.0


_BASE = 0x9E3779B97F4A7C15 | 1
_HIGH = np.uint64(48)


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_BASE, k, 1 << 64))


def _digests(strings: list[str], length: int) -> np.ndarray:
    """Digests of all beginnings of strings of one length, a row for each end."""
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length).astype(np.uint64)
    out = np.zeros((length + 1, len(strings)), np.uint64)
    for k in range(length):
        out[k + 1] = out[k] * np.uint64(_BASE) + codes[:, k] + np.uint64(1)
    return out


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and scores; ``cuts`` are characters that only stand alone as a piece."""

    ids: dict[str, int]
    scores: dict[str, float]
    first_byte: int
    longest: int = field(init=False)
    unknown: float = field(init=False)
    unit: str = field(init=False)
    border: str = field(init=False)
    tables: dict[int, tuple[np.ndarray, ...]] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        inside = {c for piece in self.ids if len(piece) > 1 for c in piece}
        cuts = "".join(c for c in "\n\t\x0b\x0c\r" if c not in inside)
        words = all(SPACE not in piece.lstrip(SPACE) for piece in self.ids)
        free = f"[^{SPACE}{cuts}]" if words else f"[^{cuts}]"
        # No piece crosses from one unit into the next.
        pattern = f"{SPACE}*{free}+|{SPACE}+" if words else f"{free}+"
        object.__setattr__(self, "unit", pattern + (f"|[{cuts}]" if cuts else ""))
        # Places where a unit starts whatever stands before: a text may be cut there.
        borders = [f"(?<!{SPACE}){SPACE}"] * words + [f"[{cuts}]"] * bool(cuts)
        object.__setattr__(self, "border", "|".join(borders) or "(?!)")
        object.__setattr__(self, "longest", max(map(len, self.ids)))
        object.__setattr__(self, "tables", self._tables())
        object.__setattr__(self, "unknown", min(s for s in self.scores.values() if s > -1e8) - _UNKNOWN_PENALTY)

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [
            i for i in range(model.vocab_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        ids = {model.id_to_piece(i): i for i in usable}
        first_byte = model.piece_to_id("<0x00>")
        assert all(model.piece_to_id(f"<0x{b:02X}>") == first_byte + b for b in range(256))
        return cls(ids, {model.id_to_piece(i): float(model.get_score(i)) for i in usable}, first_byte)

    def encode_unit(self, unit: str) -> list[int]:
        """Best path through the lattice of one unit; the longer last piece wins a tie."""
        ids, scores, longest = self.ids, self.scores, self.longest
        best, back = [0.0], [0]
        for end in range(1, len(unit) + 1):
            top, start_of = -np.inf, end - 1
            for start in range(max(0, end - longest), end):
                score = scores.get(unit[start:end])
                if score is None:
                    if start < end - 1:
                        continue
                    score = self.unknown
                if best[start] + score > top:
                    top, start_of = best[start] + score, start
            best.append(top)
            back.append(start_of)
        out, end = [], len(unit)
        while end:
            piece = unit[back[end] : end]
            own = ids.get(piece)
            out.extend([own] if own is not None else [self.first_byte + b for b in reversed(piece.encode())])
            end = back[end]
        return out[::-1]

    def _tables(self) -> dict[int, tuple[np.ndarray, ...]]:
        """Pieces by length: which high bits occur, sorted digests, scores and ids."""
        found = {}
        for length in {len(piece) for piece in self.ids}:
            pieces = [piece for piece in self.ids if len(piece) == length]
            digests = _digests(pieces, length)[-1]
            order = np.argsort(digests)
            maybe = np.zeros(1 << 16, bool)
            maybe[digests >> _HIGH] = True
            scores = np.array([self.scores[piece] for piece in pieces])[order]
            found[length] = (maybe, digests[order], scores, np.array([self.ids[piece] for piece in pieces], np.int32)[order])
        return found

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """``encode_unit`` for many units."""
        ids, sizes = self.paths(units)
        ends = np.cumsum(sizes)
        return [ids[end - size : end].tolist() for end, size in zip(ends, sizes, strict=True)]

    def paths(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many units one after the other, and how many each has: the lattices of those of
        one length are solved together, substrings looked up in the piece table by digest."""
        owners, pieces = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        by_length: dict[int, list[int]] = {}
        for k, unit in enumerate(units):
            by_length.setdefault(len(unit), []).append(k)
        for length, places in by_length.items():
            if length > LONGEST_TOGETHER:
                for k in places:
                    pieces.append(np.array(self.encode_unit(units[k]), np.int32))
                    owners.append(np.full(len(pieces[-1]), k, np.int32))
                continue
            prefix = _digests([units[k] for k in places], length)
            best = np.full((length + 1, len(places)), -np.inf)
            best[0] = 0.0
            back = np.zeros((length + 1, len(places)), np.int8)
            chosen = np.full((length + 1, len(places)), -1, np.int32)
            for end in range(1, length + 1):
                for start in range(max(0, end - self.longest), end):
                    if end - start not in self.tables:
                        continue
                    maybe, digests, scores, ids = self.tables[end - start]
                    wanted = prefix[end] - prefix[start] * _power(end - start)
                    one = end - start == 1
                    rows = slice(None) if one else np.flatnonzero(maybe[wanted >> _HIGH])
                    at = np.minimum(np.searchsorted(digests, wanted[rows]), len(digests) - 1)
                    miss = digests[at] != wanted[rows]
                    total, piece = scores[at], ids[at]
                    # A character that is no piece keeps its place.
                    total[miss], piece[miss] = self.unknown if one else -np.inf, -end
                    total += best[start][rows]
                    better = total > best[end][rows]
                    where = np.flatnonzero(better) if one else rows[better]
                    best[end][where] = total[better]
                    back[end][where] = start
                    chosen[end][where] = piece[better]
            # All paths are followed back together.
            place, live, at = np.array(places, np.int32), np.arange(len(places)), np.full(len(places), length)
            met, steps = [], []
            while live.size and length:
                met.append(place[live])
                steps.append(chosen[at, live])
                at = back[at, live].astype(np.int64)
                live, at = live[at > 0], at[at > 0]
            owners.extend(reversed(met))
            pieces.extend(reversed(steps))
        owner, piece = np.concatenate(owners), np.concatenate(pieces)
        order = np.argsort(owner, kind="stable")
        owner, piece = owner[order], piece[order]
        unknown = piece < 0
        if unknown.any():
            spelled = [units[k][-1 - p].encode() for k, p in zip(owner[unknown].tolist(), piece[unknown].tolist())]
            widths = np.ones(len(piece), np.int64)
            widths[unknown] = [len(b) for b in spelled]
            owner, piece, unknown = (np.repeat(values, widths) for values in (owner, piece, unknown))
            piece[unknown] = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int32) + self.first_byte
        return piece, np.bincount(owner, minlength=len(units))

    def units(self, text: str) -> list[str]:
        """The text in parts that no piece of the vocabulary crosses."""
        return re.findall(self.unit, SPACE + text.replace(" ", SPACE)) if text else []

    def runs(self, text: str, size: int) -> Iterator[list[str]]:
        """The units of a long text in runs of about ``size`` characters."""
        marked, border, at = SPACE + text.replace(" ", SPACE), re.compile(self.border), 0
        while text and at < len(marked):
            found = border.search(marked, at + size)
            end = found.start() if found else len(marked)
            yield re.findall(self.unit, marked[at:end])
            at = end

    def decoder(self) -> pa.Array:
        """The bytes of every id, and no bytes in the last place."""
        table = {i: piece.replace(SPACE, " ").encode() for piece, i in self.ids.items()}
        table |= {self.first_byte + b: bytes([b]) for b in range(256)}
        return pa.array([table.get(i, b"") for i in range(max(table) + 2)], pa.large_binary())


@dataclass
class Paths:
    """Words with their ids; two arrays hold the ids of all words, so that many words take little memory."""

    places: dict[str, int] = field(default_factory=dict)
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    sizes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words not yet held."""
        self.places.update(zip(words, range(len(self.places), len(self.places) + len(words))))
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int64)])


def even_slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes add up to ``most``; a larger row is a run by itself."""
    upto, lo = np.concatenate([[0], np.cumsum(sizes)]), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def decoded_texts(lists: pa.Array, table: pa.Array) -> list[str | None]:
    """The text of each list of ids."""
    return list(_texts_in_turn(lists, table))


def _texts_in_turn(lists: pa.Array, table: pa.Array) -> Iterator[str | None]:
    """The text of each list of ids; a bounded number of tokens is looked up at once."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    last = len(table) - 1
    for lo, hi in even_slices(sizes, _TOKENS_AT_ONCE):
        some = lists.slice(lo, hi - lo)
        ids = some.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        places = np.where((ids >= 0) & (ids < last), ids, last)
        ends = np.cumsum(sizes[lo:hi])
        parts: list[list[bytes]] = [[] for _ in range(hi - lo)]
        for start in range(0, len(places), _TOKENS_AT_ONCE):
            stop = min(len(places), start + _TOKENS_AT_ONCE)
            bytes_of = table.take(pa.array(places[start:stop]))
            first = int(np.searchsorted(ends, start, side="right"))
            final = int(np.searchsorted(ends, stop, side="left")) + 1
            offsets = np.concatenate([[0], np.minimum(ends[first:final], stop) - start])
            grouped = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), bytes_of.cast(pa.binary()))
            for k, joined in zip(range(first, final), pc.binary_join(grouped, b"").to_pylist()):
                parts[k].append(joined)
        for k, valid in enumerate(some.is_valid().to_pylist()):
            yield b"".join(parts[k]).decode("utf-8", "replace").removeprefix(" ") if valid else None


def lattice_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word) -> (word, ids): the lattice as relations.

    Substrings up to the longest piece are exploded and equi-joined to the piece table (a fixed
    size, so it is broadcast); a character that is no piece becomes its bytes. The edges of a word
    are grouped, and one aggregate over them in order of their ends keeps the best path to each
    position.
    """
    spark = words.sparkSession
    rows = [(piece, i, vocabulary.scores[piece]) for piece, i in vocabulary.ids.items()]
    pieces = F.broadcast(spark.createDataFrame(rows, "piece string, id int, score double"))
    start = F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start")
    last = F.least(F.length("word"), F.col("start") + vocabulary.longest)
    spans = words.where("word <> ''").select("word", start)
    spans = spans.select("word", "start", F.explode(F.sequence(F.col("start") + 1, last)).alias("end"))
    spans = spans.withColumn("piece", F.substring("word", F.col("start") + 1, F.col("end") - F.col("start")))
    joined = spans.join(pieces, "piece", "left").where("id IS NOT NULL OR end = start + 1")
    bytes_hex = F.hex(F.encode("piece", "UTF-8"))
    places = F.sequence(F.lit(0), (F.length(bytes_hex) / 2).cast("int") - 1)
    as_bytes = F.transform(
        places, lambda k: F.conv(F.substring(bytes_hex, 2 * k + 1, F.lit(2)), 16, 10).cast("int") + vocabulary.first_byte
    )
    edge = F.struct(
        "end",
        "start",
        F.coalesce("score", F.lit(vocabulary.unknown)).alias("score"),
        F.when(F.col("id").isNull(), as_bytes).otherwise(F.array("id")).alias("ids"),
    )
    edges = joined.select("word", edge.alias("edge")).groupBy("word").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    return edges.select("word", _best_path(F.col("edges")).alias("ids"))


def _best_path(edges: Column) -> Column:
    path = "struct<score:double,ids:array<int>>"
    origin = F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids"))
    # paths: to all positions before ``end``; best: to ``end`` so far.
    zero = F.struct(F.array().cast(f"array<{path}>").alias("paths"), F.lit(0).alias("end"), origin.alias("best"))

    def step(acc: Column, edge: Column) -> Column:
        from_ = F.when(edge["start"] == acc["end"], acc["best"]).otherwise(F.get(acc["paths"], edge["start"]))
        found = F.struct(
            (from_["score"] + edge["score"]).alias("score"), F.concat(from_["ids"], edge["ids"]).alias("ids")
        )
        better = F.when(found["score"] > acc["best"]["score"], found).otherwise(acc["best"])
        same = F.struct(acc["paths"].alias("paths"), acc["end"].alias("end"), better.alias("best"))
        following = F.struct(
            F.concat(acc["paths"], F.array(acc["best"])).alias("paths"), edge["end"].alias("end"), found.alias("best")
        )
        return F.when(edge["end"] == acc["end"], same).otherwise(following)

    return F.aggregate(edges, zero, step, lambda acc: acc["best"]["ids"])


def _frequent(docs: DataFrame, most: int) -> DataFrame:
    """The words that most texts hold, as they stand after a space; counted in parts and then together."""

    def counted(found: Counter[str]) -> pa.RecordBatch:
        words = pa.array((SPACE + word for word in found), pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(found.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(set((text or "").split()))
            if len(found) > _WORDS_AT_ONCE:
                yield counted(found)
                found.clear()
        yield counted(found)

    counts = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(most).where("length(word) <= 64").select("word")


def encode(
    df: DataFrame, text: str = "text", model: str = MODEL, frequent: int = FREQUENT_WORDS, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``df`` (all without it) with ``token_ids`` and ``n_tokens``; columns of
    these two names are replaced.

    A null text gives a null ``token_ids`` and 0 tokens, an empty text an empty list. Characters
    outside the vocabulary become bytes. A text's U+2581 is read as a space, as the format has it.
    Repeated rows give repeated results; an empty table gives none; texts are encoded whole, a few
    megabytes at a time: many short texts together, a long one in runs of units.

    The lattice of the most frequent words (a fixed number) is solved relationally, and their
    paths go to all tasks; a word not among them is solved over the same lattice, with the same
    tie rule, where it is met, so the result does not depend on that number. Joining every word
    of every text back to a table of all words would shuffle more than the input.
    """
    vocabulary = Vocabulary.load(model)
    spark: SparkSession = df.sparkSession
    with batches_of(spark, _BYTES_AT_ONCE):
        counted = materialise(_frequent(only(df, text=text), frequent))
    solved = materialise(lattice_words(counted, vocabulary))
    # At most ``frequent`` words of 64 characters.
    known = Paths()
    for some in solved.toArrow().to_batches():
        lists = some.column("ids")
        known.add(some.column("word").to_pylist(), lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy())
    shared = spark.sparkContext.broadcast(known)
    kept = [name for name in (df.columns if keep is None else keep) if name not in ("token_ids", "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, met, held = shared.value, Paths(), 0

        def solve(split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
            """The ids of lists of units, and how many each list has."""
            nonlocal held, met
            coded = pa.array(chain.from_iterable(split), pa.string()).dictionary_encode()
            distinct, place = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            if held > CACHED_CHARACTERS:
                met, held = Paths(), 0
            new = [unit for unit in distinct if unit not in words.places and unit not in met.places]
            met.add(new, *vocabulary.paths(new))
            held += sum(map(len, new))
            # The paths of all units in order, gathered from those of the distinct ones.
            own = len(words.places)
            at = np.array([words.places[unit] if unit in words.places else own + met.places[unit] for unit in distinct], np.int64)
            ids, lengths = (np.concatenate(pair) for pair in ((words.ids, met.ids), (words.sizes, met.sizes)))
            first, size = (np.cumsum(lengths) - lengths)[at][place], lengths[at][place]
            upto = np.concatenate([[0], np.cumsum(size)])
            ends = upto[np.concatenate([[0], np.cumsum([len(units) for units in split], dtype=np.int64)])]
            return ids[np.arange(upto[-1]) + np.repeat(first - upto[:-1], size)], np.diff(ends)

        def encoded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
            if len(texts) > 1 or len(texts[0] or "") <= _BYTES_AT_ONCE:
                return solve([vocabulary.units(value or "") for value in texts])
            runs = [solve([units])[0] for units in vocabulary.runs(texts[0], _BYTES_AT_ONCE // 4)]
            ids = np.concatenate(runs)
            return ids, np.array([len(ids)])

        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column("_text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            for lo, hi in even_slices(sizes, _BYTES_AT_ONCE):
                batch = whole.slice(lo, hi - lo)
                texts = batch.column("_text").to_pylist()
                ids, counts = encoded(texts)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                offsets = pa.array(ends, mask=np.array([t is None for t in texts] + [False]))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                columns = [batch.column(k) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists, pa.array(counts, pa.int64())], [*kept, "token_ids", "n_tokens"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept)
    named = df.select(*kept, df[text].alias("_text"))
    return named.mapInArrow(run, f"{fields + ', ' if fields else ''}token_ids array<int>, n_tokens long")


def decode(df: DataFrame, ids: str = "token_ids", output: str = "decoded", model: str = MODEL) -> DataFrame:
    """All columns of ``df`` with the text of the ids in ``output``; null ids give null.

    The space that stands before a text is taken off; an id that is no piece and no byte gives
    nothing; bytes that are not UTF-8 become U+FFFD.
    """
    return df.withColumn(output, _decoded(ids, model))


def _decoded(ids: str, model: str) -> Column:
    """Only the ids go to the tasks' Python side."""
    table = Vocabulary.load(model).decoder()

    @F.arrow_udf("string")
    def text_of(lists: pa.Array) -> pa.Array:
        return pa.array(_texts_in_turn(lists, table), pa.string())

    return text_of(F.col(ids))


def _decoded_digest(ids: str, model: str) -> Column:
    """The SHA-256 of the decoded text, which itself stays in the task."""
    table = Vocabulary.load(model).decoder()

    @F.arrow_udf("string")
    def digest_of(lists: pa.Array) -> pa.Array:
        texts = _texts_in_turn(lists, table)
        return pa.array((None if t is None else hashlib.sha256(t.encode()).hexdigest() for t in texts), pa.string())

    return digest_of(F.col(ids))


def encode_checked(
    df: DataFrame, keep: list[str], text: str = "text", output: str = "round_trip", model: str = MODEL, frequent: int = FREQUENT_WORDS
) -> DataFrame:
    """``encode``, written as a table, with whether its stored ids decode to the whole text.

    Every row's ids are decoded from the table and held against the SHA-256 of the text, so a wrong
    id, offset or count shows. A text with U+2581 decodes to a space in its place: false. A null text
    has null ids: true.
    """
    digest = next(name for k in count() if (name := f"_digest{k}") not in df.columns)
    marked = df.withColumn(digest, F.sha2(F.col(text), 256))
    encoded = encode(marked, text, model, frequent, [*keep, digest])
    with batches_of(df.sparkSession, _BYTES_AT_ONCE):
        stored = materialise(encoded)
    return round_trip(stored, digest, output, model).drop(digest)


def round_trip(stored: DataFrame, digest: str, output: str = "round_trip", model: str = MODEL) -> DataFrame:
    """Whether the ``token_ids`` of each row decode to a text of the SHA-256 in ``digest``."""
    return stored.withColumn(output, _decoded_digest("token_ids", model).eqNullSafe(F.col(digest)))
