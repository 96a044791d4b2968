"""Token counts by a compiled finite-state transducer over bytes, and composition of chunk state maps.

Byte-pair encoding inside a pre-token is a deterministic transducer. The encoding of a prefix ends in one certain token, and two
tokens stand side by side in an encoding exactly if encoding their joined bytes gives the two back. So the last token of
a longer prefix follows from the last tokens of the shorter ones. A state holds what later bytes can ask for: the longest
suffix that still begins a longer token, and for each position in it where one can begin the last token and the number of tokens less the
present one. Two tokens are compared by taking their merges back, the latest first, down to the bytes on both sides of the seam.
A transition on a byte carries the change of the number of emitted tokens. States and transitions are compiled when a text first needs them
and kept by the worker up to a bound; whole pre-tokens are remembered as paths through the transducer.

The pre-token automaton forgets its past wherever white space follows a solid character: all entry states agree from there
on. The state map of a chunk is therefore its head before the first such place, the count up to the last one, and its tail.
Maps compose associatively (a tail and the next head make a finished or a longer piece). Texts over ``CHUNK_CHARS`` are cut
into chunks that are mapped in parallel, and composed ``FAN`` neighbours at a time, round by round, as a parallel scan.

Cases: null and empty texts have no tokens; special strings count as the library's single tokens; texts without any white
space are one long head; equal long texts are counted once; an empty table gives an empty result; extra columns are kept, and clashing
names are replaced.
"""

from __future__ import annotations

import json

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, materialize, slices, text_bytes, whole_texts, worker_cache
from .pretoken import byte_symbols, default_tokenizer

CHUNK_CHARS = 1 << 15
FAN = 16
MAX_STATES = 150_000
#: Bytes at the begin of a string whose path is remembered as one step.
HEAD = 6
#: Pre-tokens that a worker remembers, in two generations of half as many.
MAX_WORDS = 300_000
#: Number of the empty token before the first byte.
_NONE = (1 << 20) - 1


class Transducer:
    """Counts the tokens of byte strings; states and transitions are compiled on first use."""

    def __init__(self, merges: list[tuple[bytes, bytes]], vocab: set[bytes]):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        made = [a + b for a, b in merges]
        # Tokens by number: single bytes, then in the order of the merges that make them.
        self.tokens = [bytes((i,)) for i in range(256)] + made
        self.numbers = {t: i for i, t in reversed([*enumerate(self.tokens)]) if t in vocab}
        # Pieces that a token can still go on from.
        self.starts = {t[:i] for t in self.numbers for i in range(1, len(t))}
        #: Each token has one merge that makes it, after those of its parts: then two tokens are compared by their parts alone.
        self.simple = len({*self.tokens}) == len(self.tokens) and len(self.numbers) == len(self.tokens)
        if self.simple:
            self.parts = [(i, i) for i in range(256)] + [(self.numbers[a], self.numbers[b]) for a, b in merges]
            self.simple = all(max(x) < i for i, x in enumerate(self.parts) if i >= 256)
            self.joined = {a << 20 | b: i for i, (a, b) in enumerate(self.parts) if i >= 256}
        self.fits: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        # A state: the open pieces (those that begin a longer token, the longest first; at last the empty one), and for each the number of
        # the token before it and the tokens up to there less the present number. _NONE stands before the first byte.
        start = (b"", (_NONE,), ())
        self.states, self.number = [((b"",), (_NONE,), (0,))], {start: 0}
        # Transitions by state and byte, and the paths of the first HEAD bytes of longer strings: (state, emitted tokens).
        self.moves: dict[int, tuple[int, int]] = {}
        self.heads: dict[bytes, tuple[int, int]] = {b"": (0, 0)}

    def encode(self, data: bytes) -> list[bytes]:
        """The encoding by merge ranks, from the definition."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 60:
                break
            pair = (parts[best[1]], parts[best[1] + 1])
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def adjacent(self, left: int, right: int) -> bool:
        """Whether encoding the joined bytes of two tokens gives the two back."""
        if not self._is_own(right) or left != _NONE and not self._is_own(left):
            return False
        if left == _NONE:
            return True
        if not self.simple:
            return self.encode(self.tokens[left] + self.tokens[right]) == [self.tokens[left], self.tokens[right]]
        # Merges are taken back, the latest first: a merge over the seam must not come before the one that covers it.
        parts, joined = self.parts, self.joined
        limit = len(parts)
        while True:
            if joined.get(left << 20 | right, limit) < limit:
                return False
            if max(left, right) < 256:
                return True
            if left > right:
                limit, left = left, parts[left][1]
            else:  # of equal merges the left one comes first
                limit, right = right + 1, parts[right][0]

    def _is_own(self, token: int) -> bool:
        if token not in self.alone:
            self.alone[token] = self.encode(self.tokens[token]) == [self.tokens[token]]
        return self.alone[token]

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        pieces, before, behind = self.states[state]
        end = bytes((byte,))
        longer = [p + end for p in pieces]
        for i, piece in enumerate(longer):  # the token that ends here: it begins at one of the open places
            token = self.numbers.get(piece)
            if token is None:
                continue
            pair = before[i] << 20 | token
            fit = self.fits.get(pair)
            if fit is None:
                if len(self.fits) > 1_000_000:
                    self.fits.clear()
                fit = self.fits[pair] = self.adjacent(before[i], token)
            if fit:
                delta = behind[i] + 1
                break
        else:
            raise ValueError(f"no token ends after {longer[0]!r}")
        kept = [i for i, piece in enumerate(longer) if piece in self.starts]
        new = (longer[kept[0]] if kept else b"", (*[before[i] for i in kept], token), tuple([behind[i] - delta for i in kept]))
        to = self.number.get(new)
        if to is None:
            to = self.number[new] = len(self.states)
            self.states.append(((*[longer[i] for i in kept], b""), new[1], (*new[2], 0)))
        step = self.moves[state << 8 | byte] = (to, delta)
        return step

    def _run(self, state: int, total: int, data: bytes) -> tuple[int, int]:
        get = self.moves.get
        for byte in data:
            state, delta = get(state << 8 | byte) or self._compile(state, byte)
            total += delta
        return state, total

    def count(self, data: bytes) -> int:
        cut = HEAD if len(data) > HEAD else 0
        head = data[:cut]
        path = self.heads.get(head)
        if path is None:
            path = self.heads[head] = self._run(0, 0, head)
        return self._run(*path, data[cut:])[1]


class Counter:
    """Token counts of texts and state maps of chunks, for one tokenizer file."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        symbols = byte_symbols()
        as_bytes = lambda s: bytes(symbols[c] for c in s)
        special = [t["content"] for t in spec["added_tokens"]]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        vocab = {as_bytes(t) for t in spec["model"]["vocab"] if t not in special}
        self.transducer = Transducer([(as_bytes(a), as_bytes(b)) for a, b in merges], vocab)
        self.split = regex.compile("|".join(regex.escape(x) for x in sorted(special, key=len, reverse=True))) if special else None
        self.words = regex.compile(public_tokenizers.PATTERN).findall
        self.meets = regex.compile(r"(?<=\S)(?=\s)")
        self.known = _Counts(self.transducer)

    def count(self, text: str) -> int:
        self.known.rotate()
        if len(self.transducer.states) > MAX_STATES:
            self.transducer.reset()
        if self.split is None or not self.split.search(text):
            return sum(map(self.known.__getitem__, self.words(text)))
        pieces = self.split.split(text)
        return sum(sum(map(self.known.__getitem__, self.words(p))) for p in pieces) + len(pieces) - 1

    def state_map(self, chunk: str, begins: bool = False, ends: bool = False) -> tuple[str, int, str | None]:
        """(head, count, tail); the tail is None where no place forgets the past. ``begins`` and ``ends`` tell that the
        chunk's ends are such places."""
        cuts = [m.start() for m in self.meets.finditer(chunk)]
        if begins:
            cuts.insert(0, 0)
        if ends:
            cuts.append(len(chunk))
        if not cuts:
            return chunk, 0, None
        return chunk[: cuts[0]], self.count(chunk[cuts[0] : cuts[-1]]), chunk[cuts[-1] :]

    def compose(self, a: tuple, b: tuple) -> tuple[str, int, str | None]:
        joint = (a[0] if a[2] is None else a[2]) + b[0]
        head, n, tail = self.state_map(joint, begins=a[2] is not None, ends=b[2] is not None)
        if tail is None:
            return head, 0, None
        return (a[0] if a[2] is not None else head), a[1] + n + b[1], (b[2] if b[2] is not None else tail)

    def total(self, m: tuple) -> int:
        return self.count(m[0]) + m[1] + (self.count(m[2]) if m[2] else 0)


class _Counts(dict):
    """Pre-token to its number of tokens: a remembered path through the transducer.

    The young generation is this dictionary; when it is full it becomes the old one, from which entries that
    are used again come back. So frequent pre-tokens stay.
    """

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer
        self.old: dict[str, int] = {}

    def rotate(self) -> None:
        if len(self) > MAX_WORDS // 2:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: str) -> int:
        n = self.old.get(word)
        if n is None:
            n = self.transducer.count(word.encode())
        self[word] = n
        return n


def counter(path: str) -> Counter:
    cache = worker_cache("transducer")
    if path not in cache:
        cache[path] = Counter(path)
    return cache[path]


def _count_batches(path: str):
    def run(batches):
        c = counter(path)
        for batch in slices(batches):
            buf, offs = text_bytes(batch.column(batch.num_columns - 1))
            for a, b in blocks(offs):
                raw = buf[offs[a] : offs[b]].tobytes()
                at = offs[a : b + 1] - offs[a]
                n = [c.count(raw[at[i] : at[i + 1]].decode("utf-8", "replace")) for i in range(b - a)]
                cols = [batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(n, pa.int64())], names=[*batch.schema.names[:-1], "n_tokens"])

    return run


_MAP = "h string, i long, head string, mid long, tail string"


def _map_batches(path: str):
    def run(batches):
        c = counter(path)
        for batch in slices(batches):
            maps = [c.state_map(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([m[k] for m in maps], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string())))],
                names=["h", "i", "head", "mid", "tail"],
            )

    return run


def _fold_batches(path: str):
    """Composes the neighbours that ``parts`` lists (at most FAN), in order."""

    def run(batches):
        c = counter(path)
        for batch in slices(batches):
            out = []
            for parts in batch.column(2).to_pylist():
                m = None
                for p in parts:
                    own = (p["head"], p["mid"], p["tail"])
                    m = own if m is None else c.compose(m, own)
                out.append(m)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([m[k] for m in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string())))],
                names=["h", "i", "head", "mid", "tail"],
            )

    return run


def _total_batches(path: str):
    def run(batches):
        c = counter(path)
        for batch in slices(batches):
            cols = [batch.column(k).to_pylist() for k in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.total(m) for m in zip(*cols)], pa.int64())], names=["__h", "n_tokens"])

    return run


def count_tokens(df: DataFrame, text_col: str = "text", path: str | None = None, carry: list[str] | None = None, chunk: int = CHUNK_CHARS) -> DataFrame:
    """The columns ``carry`` (default: all) with ``n_bytes`` and ``n_tokens`` of the whole text."""
    whole_texts(df.sparkSession)
    path = path or default_tokenizer()
    text = F.col(f"`{text_col}`").cast("string")
    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in ("n_bytes", "n_tokens")]
    src = df.select(*[F.col(f"`{c}`") for c in carry], F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce(text, F.lit("")).alias("__text"))
    schema = src.drop("__text").withColumn("n_tokens", F.lit(None).cast("long")).schema
    # a text of at most ``chunk`` bytes has no more characters
    short = src.filter(F.col("n_bytes") <= chunk).mapInArrow(_count_batches(path), schema)
    long = src.filter(F.col("n_bytes") > chunk).withColumn("__h", F.sha2("__text", 256))
    top = df.select(F.max(F.octet_length(text)).alias("n")).first()["n"] or 0
    if top <= chunk:
        return short
    texts = long.groupBy("__h").agg(F.min("__text").alias("__text"))
    pieces = texts.select(
        F.col("__h").alias("h"), F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.length("__text") - 1) / chunk)), lambda k: F.substring("__text", (k * chunk + 1).cast("int"), F.lit(chunk)))).alias("i", "piece")
    ).select("h", F.col("i").cast("long").alias("i"), "piece")
    maps = pieces.repartition("h", "i").mapInArrow(_map_batches(path), _MAP)
    width = -(-top // chunk)
    while width > 1:
        near = maps.groupBy("h", F.floor(F.col("i") / FAN).alias("i")).agg(F.sort_array(F.collect_list(F.struct(F.col("i").alias("k"), "head", "mid", "tail"))).alias("parts"))
        maps = near.mapInArrow(_fold_batches(path), _MAP)
        width = -(-width // FAN)
    totals = maps.mapInArrow(_total_batches(path), "__h string, n_tokens long")
    counted = long.drop("__text").join(totals, "__h").select(*[f"`{c}`" for c in schema.fieldNames()])
    return short.unionByName(counted)
