"""Byte-level BPE as a bounded-lookahead streaming transducer, and decoding as a byte-to-text state machine.

*Sufficient lookahead.* Apply the merges rule by rule, in order, to two inputs that agree up to a frontier.
A rule (u, v) moves the frontier left only where u ends at it and v follows in one input alone, by len(u) bytes.
The next rule (u', v') that moves it further has a v' that starts at the new frontier, so v' starts with the
bytes of u, and it comes later in the list. The longest such chain, weighted by len(u), bounds how far an unseen
byte can reach back: tokens that end at least that many bytes before the end of what has been read are final.
``MergeTable`` computes this bound in one pass over the merge list.

*Streaming.* ``Encoder.feed`` takes a text in pieces of any size. It holds back what more text may change: a special token's
beginning, and the text behind the last place that no pretoken spans. ``Piece`` merges a pretoken in windows of ``window``
bytes; after each window the tokens that are final are emitted and the next window starts behind them (no later merge
crosses an emitted boundary). A pretoken without end, as a text without spaces is, goes to a ``Piece`` as it comes. Memory is
a block of text and a window, whatever the length of text or pretoken. Words are memoised in a bounded table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The pretoken pattern of byte-level BPE and the white space it tells from other characters.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACES = "\t\n\x0b\x0c\r \x85\xa0                　"

_pretokens = regex.compile(PRETOKEN).findall
_chunks = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+").findall
_space_run = re.compile(f" [{SPACES}]|^[{SPACES}]").search
_settled = re.compile(f".*[^{SPACES}](?= [^{SPACES}])", re.DOTALL).match
_pretoken_spans = regex.compile(PRETOKEN).finditer
#: The classes of runs that a pretoken can be, each as the pattern of one more part of it.
_runs = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]
BLOCK = 1 << 16


@lru_cache(1)
def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: itself, or the next free one from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """A merge list with its vocabulary, the sufficient lookahead and the window of the transducer."""

    def __init__(self, spec: dict):
        model, alphabet = spec["model"], byte_alphabet()
        if model.get("ignore_merges") or model.get("dropout") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("only plain byte-level BPE is known")
        as_bytes = lambda token: bytes(map(alphabet.__getitem__, token))
        vocab = model["vocab"]
        self.text_of = {i: as_bytes(t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of |= {i: t.encode() for t, i in self.special.items()}
        self.first = [0] * 256
        for token, i in vocab.items():
            if len(token) == 1:
                self.first[alphabet[token]] = i
        self.rank: dict[tuple[int, int], int] = {}
        self.joined: list[int] = []
        made: set[str] = set(alphabet)
        reach: dict[bytes, int] = {}
        self.lookahead = 1
        longest = 1
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if left not in made or right not in made:
                raise ValueError("a merge uses a token that no earlier merge makes")
            made.add(left + right)
            self.rank[vocab[left], vocab[right]] = rank
            self.joined.append(vocab[left + right])
            u, v = as_bytes(left), as_bytes(right)
            chain = len(u) + max((reach.get(v[:k], 0) for k in range(1, len(v) + 1)), default=0)
            reach[u] = max(reach.get(u, 0), chain)
            self.lookahead = max(self.lookahead, chain)
            longest = max(longest, len(u) + len(v))
        self.window = max(256, 2 * self.lookahead + longest)
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").search if self.special else None

    def merge(self, data: bytes) -> list[int]:
        """The tokens of a whole piece: the earliest rule first, leftmost first."""
        first, rank, joined = self.first, self.rank, self.joined
        ids = [first[b] for b in data]
        if len(ids) > 64:
            return self._merge_long(ids)
        none = len(joined)
        ranks = [rank.get(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [joined[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank.get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        rank, joined = self.rank, self.joined
        n = len(ids)
        after, before, alive = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or rank.get((ids[i], ids[j])) != r:
                continue
            ids[i], alive[j], after[i] = joined[r], False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (r, a))
        return [x for x, ok in zip(ids, alive) if ok]

    def stream(self, data: bytes, window: int | None = None) -> Iterator[int]:
        """Tokens of one whole pretoken."""
        piece = Piece(self, window)
        yield from piece.feed(data)
        yield from piece.finish()


class Piece:
    """One pretoken, fed in bytes: tokens are emitted once they are final; ``window`` bytes are held at most."""

    def __init__(self, table: MergeTable, window: int | None = None):
        self.table, self.window, self._data = table, window or table.window, bytearray()

    def feed(self, data: bytes) -> Iterator[int]:
        for lo in range(0, len(data), self.window):
            self._data += data[lo : lo + self.window]
            while len(self._data) > self.window:
                stable, start = self.window - self.table.lookahead, 0
                for token in self.table.merge(bytes(self._data[: self.window])):
                    size = len(self.table.text_of[token])
                    if start + size > stable:
                        break
                    start += size
                    yield token
                del self._data[:start]

    def finish(self) -> Iterator[int]:
        data, self._data = bytes(self._data), bytearray()
        yield from self.table.merge(data)


class Memo(dict):
    """A function's values in two generations of ``most`` entries, so that memory stays bounded."""

    def __init__(self, f, most: int):
        super().__init__()
        self.f, self.most, self.old = f, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.f(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Text to ids. ``feed`` takes the next part of a text and ``finish`` ends it; both yield ids as decimal text."""

    def __init__(self, table: MergeTable, memo: int = 250_000, block: int = BLOCK):
        self.table, self.block = table, block
        # neither memo refers to the encoder, so both go with it, not with the next collection of cycles
        word = Memo(lambda w: ",".join(map(str, table.stream(w.encode()))), memo // 2)

        def merged(chunk: str) -> str:
            """A chunk of one pretoken, as most are, is remembered as a chunk only."""
            words = _pretokens(chunk)
            if len(words) == 1:
                return word.get(chunk) or ",".join(map(str, table.stream(chunk.encode())))
            return ",".join(map(word.__getitem__, words))

        self._word, self._chunk = word, Memo(merged, memo)
        self._longest = max(map(len, table.special), default=0)
        self._raw = ""  # may begin a special token
        self._text = ""  # plain text that is not settled
        self._open: tuple | None = None  # a pretoken without end so far: its class of characters and its Piece

    def feed(self, text: str) -> Iterator[str]:
        for lo in range(0, len(text), self.block):
            yield from self._specials(text[lo : lo + self.block], False)

    def finish(self) -> Iterator[str]:
        yield from self._specials("", True)

    def _specials(self, text: str, last: bool) -> Iterator[str]:
        raw = self._raw + text
        if self.table._special:
            while found := self.table._special(raw):
                if not last and found.start() + self._longest > len(raw):
                    break  # a longer one may start here
                yield from self._plain(raw[: found.start()], True)
                yield str(self.table.special[found[0]])
                raw = raw[found.end() :]
        hold = 0 if last else min(len(raw), max(0, self._longest - 1))
        self._raw = raw[len(raw) - hold :]
        yield from self._plain(raw[: len(raw) - hold], last)

    def _plain(self, text: str, last: bool) -> Iterator[str]:
        """Text without special tokens; ``last`` ends it."""
        text = self._text + text
        self._text = ""
        if self._open:
            text = yield from self._continued(text, last)
        if last:
            if text:
                yield self._settle(text)
            return
        if len(text) >= self.block:
            if cut := _settled(text):
                yield self._settle(cut[0])
                text = text[cut.end() :]
            if len(text) >= self.block:  # no place to cut: pretoken by pretoken, and the last one as it comes
                text = yield from self._run(text)
        self._text = text

    def _run(self, text: str) -> Iterator[str]:
        *done, tail = _pretoken_spans(text)
        if len(done) > 2:  # what follows may still change the last two
            start = done[-2].start()
            yield ",".join(map(self._word.__getitem__, (x[0] for x in done[:-2])))
            return text[start:]
        if len(tail[0]) < self.block // 2:
            return text
        if done:
            yield ",".join(map(self._word.__getitem__, (x[0] for x in done)))
        kind = next(k for k in _runs if k.fullmatch(tail[0][-1]))
        self._open = kind, Piece(self.table)
        return (yield from self._continued(tail[0], False, lead=tail[0][0] == " " and kind is not _runs[3]))

    def _continued(self, text: str, last: bool, lead: bool = False) -> Iterator[str]:
        """Feed the open pretoken; returns the text behind it. Of white space the last character waits: it may go to a word."""
        kind, piece = self._open
        end = kind.match(text, int(lead))
        cut = end.end() if end else 0
        ended = cut < len(text) or last
        if kind is _runs[3] and not (last and cut == len(text)):
            cut = max(0, cut - 1)
        ids = list(piece.feed(text[:cut].encode()))
        if ended:
            ids += piece.finish()
            self._open = None
        if ids:
            yield ",".join(map(str, ids))
        return text[cut:]

    def _settle(self, block: str) -> str:
        if _space_run(block):
            return ",".join(map(self._chunk.__getitem__, _chunks(block)))
        head, *rest = block.split(" ")
        found = [self._chunk[head]] if head else []
        return ",".join(found + list(map(self._chunk.__getitem__, [" " + x for x in rest])))

    def parts(self, text: str) -> Iterator[str]:
        """A whole text, whatever became of the one before."""
        self._raw, self._text, self._open = "", "", None
        yield from self.feed(text)
        yield from self.finish()

    def encode(self, text: str) -> list[int]:
        return [int(x) for part in self.parts(text) for x in part.split(",")]


class Decoder:
    """Ids to text: bytes are fed as they come; an unfinished character waits for its rest."""

    def __init__(self, table: MergeTable):
        self._bytes, self._pending = table.text_of, b""

    def feed(self, ids: Iterable[int]) -> str:
        data = self._pending + b"".join(map(self._bytes.__getitem__, ids))
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                if (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4) > back:
                    cut -= back
                break
            if lead < 0x80:
                break
        self._pending = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self._pending = self._pending, b""
        return rest.decode("utf-8", "replace")

    def decode(self, ids: Iterable[int]) -> str:
        return self.feed(ids) + self.finish()


def load(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


@lru_cache(2)
def table_of(spec: str) -> MergeTable:
    return MergeTable(json.loads(spec))


def _rows(spec: str, with_ids: bool, memo: int):
    table = table_of(spec)
    encoder = Encoder(table, memo)

    def one(text: str | None) -> tuple:
        ids, back, decoder, n, kept = hashlib.sha256(), hashlib.sha256(), Decoder(table), 0, []
        for part in encoder.parts(text or ""):
            tokens = list(map(int, part.split(",")))
            ids.update((("," if n else "") + part).encode())
            n += len(tokens)
            back.update(decoder.feed(tokens).encode())
            if with_ids:
                kept += tokens
        back.update(decoder.finish().encode())
        return n, ids.hexdigest(), back.hexdigest(), kept

    return one


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, memo: int = 250_000) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids_sha256, decoded_sha256, and ``ids`` if asked for.

    Texts are encoded whole. Null counts as empty; an empty text has no tokens and the digests of the empty string.
    Special tokens' strings in a text become those tokens, as the tokenizer's file has them. Repeated rows give repeated
    results; other columns are ignored. The tokenizer's file (a few MB) is read on the driver and broadcast.
    A task remembers the tokens of ``memo`` words and a half, twice: 160 MB of the default, 50 MB of 80,000.
    """
    spec = docs.sparkSession.sparkContext.broadcast(load(tokenizer))
    schema = f"{id_col} bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches):
        one = _rows(spec.value, with_ids, memo)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [one(t) for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.string())]
                if with_ids:
                    columns.append(pa.array([x[3] for x in found], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

    return docs.select(docs[id_col].cast("bigint").alias(id_col), docs[text_col].alias("text")).mapInArrow(run, schema)


def decode_documents(tokens: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts from arrays of ids; null gives null. Bytes that are not UTF-8 become U+FFFD."""
    spec = tokens.sparkSession.sparkContext.broadcast(load(tokenizer))

    def run(batches):
        table = table_of(spec.value)
        for batch in batches:
            texts = [None if ids is None else Decoder(table).decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return tokens.select(id_col, ids_col).mapInArrow(run, f"{id_col} bigint, text string")
