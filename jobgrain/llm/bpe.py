"""BPE as a streaming transducer with bounded lookahead, and decoding as an incremental state machine.

The merge list alone fixes how far a later symbol can reach back (``sufficient_lookahead``, after the published analysis
of BPE as a finite-state translation): a rule ``u v`` may be undone at a place only if the right end of ``v`` is taken by
an earlier rule, whose right side may again be taken by a still earlier one. The longest such chain, in symbols, is the
lookahead. Tokens that end that far before the read position are stable and leave the buffer; what stays is merged anew
from a token boundary, which changes nothing, because a part of a tokenisation between boundaries is its own tokenisation.
So the state is one window of text, one open pre-token and at most ``block + lookahead`` symbols.

The list must be proper (each rule's sides are single symbols or made by earlier rules); others are refused.

Defined cases: a null text counts as empty: no ids, and it decodes to the empty text; texts of any length are read in
windows, and a window grows over a run of combining characters that is longer, which normal form C takes whole; ids that the file does not know are skipped in decoding, as the library does; repeated rows keep their rows.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobgrain.llm import pretokens

#: Characters of a window, symbols of a buffer beyond the lookahead, chunks kept in a worker's cache.
WINDOW, BLOCK, CACHE = 1 << 16, 1024, 400_000
_NONE = 1 << 40


class Merges:
    """Vocabulary and merge list of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.rules = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in pairs]
        self.rank = {a << 32 | b: i for i, (a, b, _) in reversed([*enumerate(self.rules)])}
        self.made = [c for _, _, c in self.rules]
        symbols = pretokens.SYMBOLS
        self.inner = [self.vocab[s] for s in symbols]
        self.last = {self.vocab[s]: self.vocab[s + end] for s in symbols}
        self.width = {i: 1 for i in [*self.inner, *self.last.values()]}
        self.lookahead = self.sufficient_lookahead()

    def sufficient_lookahead(self) -> int:
        """Symbols after a boundary that decide whether it stays one; also checks that the list is proper."""
        right_end: dict[int, tuple[int, ...]] = {i: (i,) for i in self.width}
        reach: dict[int, int] = {}  # longest reach of the rules so far, by their left side
        most = 0
        for a, b, c in self.rules:
            if a not in right_end or b not in right_end:
                raise ValueError("the merge list is not proper")
            far = self.width[b] + max((reach.get(s, 0) for s in right_end[b]), default=0)
            most = max(most, far)
            reach[a] = max(reach.get(a, 0), far)
            if c not in right_end:
                self.width[c] = self.width[a] + self.width[b]
                right_end[c] = (c, *right_end[b])
        return most + 1  # one more: whether a symbol is the last is known a symbol later

    def merged(self, symbols: list[int]) -> list[int]:
        """All merges of one buffer."""
        return self._short(symbols) if len(symbols) <= 64 else self._long(symbols)

    def _short(self, parts: list[int]) -> list[int]:
        rank, made = self.rank.get, self.made
        ranks = [rank(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            parts[i] = made[best]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 32 | parts[i + 1], _NONE)
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        """The same with a heap over linked positions."""
        n, rank, made = len(parts), self.rank.get, self.made
        before, after, live = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(r, i) for i in range(n - 1) if (r := rank(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not live[i] or j >= n or rank(parts[i] << 32 | parts[j]) != r:
                continue
            parts[i], live[j], after[i] = made[r], False, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (x := rank(parts[i] << 32 | parts[after[i]])) is not None:
                    heapq.heappush(heap, (x, i))
            if before[i] >= 0 and (x := rank(parts[before[i]] << 32 | parts[i])) is not None:
                heapq.heappush(heap, (x, before[i]))
        return [p for p, ok in zip(parts, live) if ok]


class WordTransducer:
    """One pre-token, fed in parts; ids come out as soon as no continuation can change them."""

    def __init__(self, merges: Merges, block: int = BLOCK):
        self._merges, self._block, self._buffer = merges, block, []

    def feed(self, text: str) -> Iterator[int]:
        inner, hold = self._merges.inner, self._merges.lookahead
        data = text.encode()
        for start in range(0, len(data), self._block):
            self._buffer += [inner[b] for b in data[start : start + self._block]]
            if len(self._buffer) > self._block + hold:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        end, limit = 0, len(self._buffer) - self._merges.lookahead
        for token in self._merges.merged(self._buffer[:]):
            width = self._merges.width[token]
            if end + width > limit:
                break
            end += width
            yield token
        del self._buffer[:end]

    def finish(self) -> list[int]:
        parts, self._buffer = self._buffer, []
        if parts:
            parts[-1] = self._merges.last[parts[-1]]
        return self._merges.merged(parts)


_OPEN = {"letter": re.compile(f"[{pretokens._LATIN}]+"), "other": re.compile(f"[^{pretokens.SPACE}0-9{pretokens._LATIN}]+")}
_OPEN_EXACT = {
    "letter": pretokens.regex.compile(r"\p{L}+"),
    "other": pretokens.regex.compile(rf"[^{pretokens.SPACE}\p{{L}}\p{{N}}]+"),
}


def _joins_back(char: str) -> bool:
    """Whether normal form C might combine the character with the one before it: marks and conjoining letters."""
    return unicodedata.category(char)[0] == "M" or bool(unicodedata.combining(char)) or "\u1160" <= char <= "\u11ff"


class StreamEncoder:
    """Text to ids in constant memory."""

    def __init__(self, path: str, window: int = WINDOW, cache: int = CACHE):
        self.merges, self.special = Merges(path), pretokens.special_tokens(path)
        top = max([*self.merges.vocab.values(), *self.special.values()])
        self.kind = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self._window = window
        self._chunks = pretokens.BoundedCache(self._chunk, cache)
        # A word comes back in other chunks: with other marks and digits beside it.
        self._words = pretokens.BoundedCache(self._ids, cache // 4)

    def _bytes(self, ids: Iterable[int]) -> bytes:
        ids = [*ids]
        return struct.pack(f"<{len(ids)}{'H' if self.kind.itemsize == 2 else 'I'}", *ids)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a part without white space."""
        ids: list[int] = []
        for part in pretokens.split_special(chunk, self.special):
            if part in self.special:
                ids.append(self.special[part])
                continue
            for word in pretokens.words_of(pretokens.lower_form(part)):
                ids += self._words[word]
        return self._bytes(ids)

    def _ids(self, word: str) -> list[int]:
        return [*self._word(word)]

    def _word(self, word: str) -> Iterable[int]:
        data = word.encode()
        if len(data) <= BLOCK:  # within one buffer: what a transducer's end makes of it
            merges = self.merges
            parts = [*map(merges.inner.__getitem__, data)]
            parts[-1] = merges.last[parts[-1]]
            return merges.merged(parts)
        return self._fed(word)

    def _fed(self, word: str) -> Iterator[int]:
        transducer = WordTransducer(self.merges)
        yield from transducer.feed(word)
        yield from transducer.finish()

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids in file order, as little-endian bytes, a window at a time."""
        at, size = 0, len(text)
        while at < size:
            end = min(size, at + self._window)
            if end < size:
                end = 1 + max(text.rfind(" ", at, end), text.rfind("\n", at, end))
                if end <= at:  # no blank in the whole window: a long run without white space
                    found = pretokens.SPACES.search(text, at)
                    yield from self._run(text, at, found.start() if found else size)
                    at = found.end() if found else size
                    continue
            yield b"".join(map(self._chunks.__getitem__, pretokens.white_split(text[at:end])))
            at = end

    def _cut(self, text: str, at: int, end: int) -> int:
        """The end of a window of a long run: not inside a special string, a combination or a contraction.

        A combination longer than a window is held whole.
        """
        whole = cut = min(end, at + self._window)
        if cut == end:
            return end
        while at + 1 < cut and _joins_back(text[cut]):
            cut -= 1
        if _joins_back(text[cut]):
            cut = whole
            while cut < end and _joins_back(text[cut]):
                cut += 1
            return cut
        safe = cut
        while at + 1 < safe and "'" in text[max(at, safe - 2) : safe]:
            safe -= 1
        cut = safe if safe > at + 1 else cut
        longest = max(map(len, self.special), default=1)
        crossing = (p for p in range(max(at + 1, cut - longest + 1), cut) if any(text.startswith(x, p) and p + len(x) > cut for x in self.special))
        return next(crossing, cut)

    def _run(self, text: str, at: int, end: int) -> Iterator[bytes]:
        word, kind = WordTransducer(self.merges), ""
        while at < end:
            cut = self._cut(text, at, end)
            for part in pretokens.split_special(text[at:cut], self.special):
                if part in self.special:
                    yield self._bytes([*word.finish(), self.special[part]])
                    kind = ""
                    continue
                part = pretokens.lower_form(part)
                exact = pretokens.UNPLAIN.search(part)
                if kind and (more := (_OPEN_EXACT if exact else _OPEN)[kind].match(part)):
                    yield self._bytes(word.feed(more.group()))
                    part = part[more.end() :]
                    if not part:
                        continue
                yield self._bytes(word.finish())
                kind = ""
                words = pretokens.words_of(part)
                yield self._bytes([i for x in words[:-1] for i in self._word(x)])
                if words:
                    letter, other = (bool((_OPEN_EXACT if exact else _OPEN)[k].fullmatch(words[-1])) for k in ("letter", "other"))
                    yield self._bytes(word.feed(words[-1]))
                    kind = "letter" if letter else "other" if other else ""
                    if not kind:
                        yield self._bytes(word.finish())
            at = cut
        yield self._bytes(word.finish())


class StreamDecoder:
    """Ids to text, fed in parts. The state is the unfinished character, or whether a separator is due."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        vocab = parts["model"]["vocab"] | {x["content"]: x["id"] for x in parts["added_tokens"]}
        self.tokens = {i: token for token, i in vocab.items()}
        self._as_bytes = (parts["decoder"] or {}).get("type") == "ByteLevel"
        if self._as_bytes:
            values = {s: b for b, s in enumerate(pretokens.SYMBOLS)}
            self.tokens = {
                i: bytes(values[c] for c in t) if all(c in values for c in t) else t.encode() for i, t in self.tokens.items()
            }
        self.reset()

    def reset(self) -> StreamDecoder:
        self._open, self._state = False, codecs.getincrementaldecoder("utf-8")("replace")
        return self

    def feed(self, ids: Iterable[int]) -> str:
        known = [t for t in map(self.tokens.get, ids) if t is not None]
        if self._as_bytes:
            return self._state.decode(b"".join(known))
        text = " " * (self._open and bool(known)) + " ".join(known)
        self._open |= bool(known)
        return text

    def finish(self) -> str:
        return self._state.decode(b"", True)


@lru_cache(maxsize=2)
def coder(path: str) -> tuple[StreamEncoder, StreamDecoder]:
    """One pair for each worker process."""
    return StreamEncoder(path), StreamDecoder(path)


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every row as little-endian bytes of the file's id width."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = coder(path)[0]
        for batch in batches:
            ids = [b"".join(encoder.encode(value.as_py() or "")) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encoded, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the text decoded from them.

    Both digests take the stream a window at a time, so no row is held in more than one form.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coder(path)
        names: dict[int, str] = {i: str(i) for i in decoder.tokens}
        for batch in batches:
            rows = []
            for value in batch.column(1):
                count, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                decoder.reset()
                for window in encoder.encode(value.as_py() or ""):
                    ids = np.frombuffer(window, encoder.kind).tolist()
                    if ids:
                        ids_hash.update((" " * bool(count) + " ".join(map(names.__getitem__, ids))).encode())
                        text_hash.update(decoder.feed(ids).encode())
                        count += len(ids)
                text_hash.update(decoder.finish().encode())
                rows.append((count, ids_hash.hexdigest(), text_hash.hexdigest()))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digests, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
