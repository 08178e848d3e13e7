"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

The merge list is read from a public tokenizer file; nothing is trained. A merge joins
two neighbours of its kind, in the order of the list. Encoding reads a text in windows
and holds back only what later text can still change:

* The splitter holds back the last piece of a window. A piece that fills a window (a very
  long word, say) is passed on part by part.
* Inside a piece, the transducer holds back as many bytes as the merge list's lookahead.

The lookahead follows from the list. Take two texts with a common beginning and apply
merge by merge to both. What they agree on ends at the common end at first. It gets
shorter only if a merge ``(u, v)`` joins the last agreed token ``u`` across that end, by
the length of ``u``; the token that then starts there has ``u`` at its left edge in
either text. So the next merge ``(u2, v2)`` that does it must come later in the list and
``v2`` must have ``u`` among the tokens at its left edge. The longest such chain bounds
the loss, and one pass over the list finds it. A token that ends before it is final.
"""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweft.llm.common import map_batches, text_blocks

#: Characters of a text, and ids, that are looked at together.
WINDOW = 1 << 16

#: Pieces whose tokens a task remembers: at most twice so many, of at most so many characters.
KNOWN_PIECES, KNOWN_LENGTH = 1 << 18, 48

#: Pieces whose tokens are found together.
PIECES_AT_ONCE = 4096

#: Up to so many bytes, all merges of a piece are looked through for each one made.
SHORT_PIECE = 64

#: A merge is one number: its place in the list above the bits of the token it makes.
TOKEN_BITS = 24
TOKEN_MASK, NEVER = (1 << TOKEN_BITS) - 1, 1 << 62

#: A tokenizer file goes to every task; a larger one is refused.
FILE_BYTES = 64 << 20

#: Code points that are letters or numbers since Unicode 17 only, as first
#: and last. The byte-level pattern is defined by Unicode 16, where they are neither.
UNICODE_17 = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]

#: No character below this one is among them.
FIRST_NEW = UNICODE_17[0][0]

_NEW = "".join(f"\\U{first:08X}-\\U{last:08X}" for first, last in UNICODE_17)
LETTER, NUMBER, SPACE = rf"[\p{{L}}--[{_NEW}]]", rf"[\p{{N}}--[{_NEW}]]", r"\s"
OTHER = rf"(?:[^\s\p{{L}}\p{{N}}]|[{_NEW}])"


def _splitter(compiled, letter: str, number: str, other: str, space: str, dark: str):
    """The public byte-level pattern: words, contractions, numbers, signs with a space before, spaces."""
    return compiled(
        rf" ?{letter}+|'(?:[stmd]|re|ve|ll)| ?{number}+| ?{other}+|{space}+(?!{dark})|{space}+"
    )


PIECES = _splitter(lambda p: regex.compile(p, regex.V1), LETTER, NUMBER, OTHER, r"\s", r"\S")


def _old_splitter():
    """The same for characters below ``FIRST_NEW``, which are listed by class; it runs twice as fast."""

    def members(kind: str) -> str:
        wanted = regex.compile(kind, regex.V1)
        return "".join(re.escape(chr(c)) for c in range(FIRST_NEW) if wanted.match(chr(c)))

    letter, number, space = members(LETTER), members(NUMBER), members(SPACE)
    return _splitter(
        re.compile, f"[{letter}]", f"[{number}]", f"[^{letter}{number}{space}]", f"[{space}]", f"[^{space}]"
    )


OLD_PIECES = _old_splitter()
RUNS = {kind: regex.compile(f"{kind}*", regex.V1) for kind in (LETTER, NUMBER, OTHER, SPACE)}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves; the rest follow from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and added tokens of a byte-level tokenizer file."""

    def __init__(self, content: bytes):
        file = json.loads(content)
        model, letters = file["model"], byte_letters()
        if model["type"] != "BPE" or file["pre_tokenizer"] != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        }:
            raise ValueError("only byte-level BPE with the public pattern and no added space is supported")
        if file.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("normalizer, dropout and ignore_merges are not supported")
        ids = model["vocab"]
        self.bytes_of = {n: bytes(letters[c] for c in token) for token, n in ids.items()}
        self.first = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        #: Place in the list and token made, as one number, by the pair that is merged.
        self.merges: dict[tuple[int, int], int] = {}
        if max(ids.values()) > TOKEN_MASK:
            raise ValueError(f"ids above {TOKEN_MASK} are not supported")
        made = set(self.first)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            u, v, both = ids[left], ids[right], ids[left + right]
            if u not in made or v not in made or both in made:
                raise ValueError(f"merge {rank} uses a token that is not made yet or makes one again")
            made.add(both)
            self.merges[u, v] = rank << TOKEN_BITS | both
        self.added = {}
        for token in file.get("added_tokens", []):
            if any(token.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError("added tokens are only supported as plain strings")
            self.added[token["content"]] = token["id"]
            known = all(c in letters for c in token["content"])
            self.bytes_of[token["id"]] = (
                bytes(letters[c] for c in token["content"]) if known else token["content"].encode()
            )
        pairs = np.array([u << TOKEN_BITS | v for u, v in self.merges], np.int64)
        order = np.argsort(pairs)
        #: All merges once more, for many lookups at a time.
        self.pairs, self.codes = pairs[order], np.array(list(self.merges.values()), np.int64)[order]
        self.longest = max(len(self.bytes_of[n]) for n in made)
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """Bytes before an open end that later text may still change."""
        edge = {n: (n,) for n in self.first}
        lost: dict[int, int] = {}
        most = 0
        for (u, v), code in self.merges.items():
            now = len(self.bytes_of[u]) + max((lost.get(t, 0) for t in edge[v]), default=0)
            lost[u] = max(lost.get(u, 0), now)
            both = code & TOKEN_MASK
            edge[both] = (*edge[u], both)
            most = max(most, now)
        return most

    def merged(self, data: bytes) -> list[int]:
        """Tokens of a piece that is whole: the first merge of the list goes first, at its leftmost place."""
        tokens = [self.first[b] for b in data]
        if len(tokens) > SHORT_PIECE:
            return self._merged_by_heap(tokens)
        get = self.merges.get
        codes = [get(pair, NEVER) for pair in zip(tokens, tokens[1:])]
        while codes and (code := min(codes)) < NEVER:
            at = codes.index(code)
            tokens[at : at + 2] = [code & TOKEN_MASK]
            del codes[at]
            if at:
                codes[at - 1] = get((tokens[at - 1], tokens[at]), NEVER)
            if at < len(codes):
                codes[at] = get((tokens[at], tokens[at + 1]), NEVER)
        return tokens

    def merged_all(self, pieces: list[bytes]) -> list[list[int]]:
        """``merged`` of many short pieces: every step makes the next merge of each of them.

        A row of ``tokens`` is a piece and a row of ``codes`` the merges that its neighbours
        allow. What a merge joins leaves a gap that the rest of the row closes, and two
        codes of the row are looked up anew. Rows without a merge left are done.
        """
        width = max(map(len, pieces), default=0)
        if width < 2:
            return [self.merged(p) for p in pieces]
        sizes = np.array([len(p) for p in pieces])
        letters = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        tokens = np.where(np.arange(width) < sizes[:, None], np.array(self.first, np.int64)[letters], -1)
        codes = self._codes(tokens[:, :-1], tokens[:, 1:])
        rows, out, columns = np.arange(len(pieces)), [[]] * len(pieces), np.arange(width)
        while len(rows):
            at = codes.argmin(1)
            best = codes[np.arange(len(rows)), at]
            done = best == NEVER
            if done.any():
                ends = (tokens[done] >= 0).sum(1).tolist()
                for row, found, end in zip(rows[done].tolist(), tokens[done].tolist(), ends):
                    out[row] = found[:end]
                rows, tokens, codes, at, best = (x[~done] for x in (rows, tokens, codes, at, best))
            every = np.arange(len(rows))
            tokens[every, at] = best & TOKEN_MASK
            tokens = np.take_along_axis(
                np.pad(tokens, ((0, 0), (0, 1)), constant_values=-1), columns + (columns > at[:, None]), 1
            )
            codes = np.take_along_axis(
                np.pad(codes, ((0, 0), (0, 1)), constant_values=NEVER), columns[:-1] + (columns[:-1] >= at[:, None]), 1
            )
            for left in (at - 1, at):
                some = (left >= 0) & (left < width - 1)
                row, left = every[some], left[some]
                codes[row, left] = self._codes(tokens[row, left], tokens[row, left + 1])
        return out

    def _codes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merges of neighbours, ``NEVER`` where there is none."""
        wanted = left << TOKEN_BITS | right
        place = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        found = (self.pairs[place] == wanted) & (left >= 0) & (right >= 0)
        return np.where(found, self.codes[place], NEVER)

    def _merged_by_heap(self, tokens: list[int]) -> list[int]:
        """The same for many tokens: neighbours are linked, and possible merges wait in a heap."""
        n, get = len(tokens), self.merges.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs = enumerate(zip(tokens, tokens[1:]))
        waiting = [(code, at) for at, pair in pairs if (code := get(pair, NEVER)) != NEVER]
        heapify(waiting)
        while waiting:
            code, at = heappop(waiting)
            right = after[at]
            if tokens[at] < 0 or right >= n or get((tokens[at], tokens[right])) != code:
                continue
            tokens[at], tokens[right] = code & TOKEN_MASK, -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n:
                    new = get((tokens[left], tokens[after[left]]), NEVER)
                    if new != NEVER:
                        heappush(waiting, (new, left))
        return [t for t in tokens if t >= 0]


class Transducer:
    """Bytes of one piece in, final tokens out, with a buffer of fixed size."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, bytearray()
        #: The first token of a block ends before the lookahead, so every block emits.
        self.block = 8 * (vocabulary.lookahead + vocabulary.longest)

    def feed(self, data: bytes) -> Iterator[int]:
        """Tokens that no later bytes can change."""
        self.held += data
        start, final = 0, self.block - self.vocabulary.lookahead
        while len(self.held) - start >= self.block:
            end = 0
            for token in self.vocabulary.merged(bytes(self.held[start : start + self.block])):
                size = len(self.vocabulary.bytes_of[token])
                if end + size > final:
                    break
                end += size
                yield token
            start += end
        del self.held[:start]

    def finish(self) -> list[int]:
        """The tokens held back, now that the piece has ended."""
        rest = self.vocabulary.merged(bytes(self.held))
        self.held.clear()
        return rest


class _Known(dict):
    """Tokens of the pieces met so far.

    When it is full, its pieces become the older ones, those that were the older ones
    before are forgotten, and what is met again is taken back.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def learn(self, pieces: Iterable[str]) -> None:
        """Find the tokens of many pieces at once."""
        new = [p for p in set(pieces) if p not in self]
        if len(self) + len(new) > KNOWN_PIECES:
            self.older = dict(self)
            self.clear()
        older = self.older
        self.update((p, older[p]) for p in new if p in older)
        short = [p for p in new if p not in older and len(p) <= KNOWN_LENGTH]
        for start in range(0, len(short), PIECES_AT_ONCE):
            some = short[start : start + PIECES_AT_ONCE]
            # Tuples of numbers cost the garbage collector nothing.
            self.update(zip(some, map(tuple, self.vocabulary.merged_all([p.encode() for p in some]))))

    def __missing__(self, piece: str) -> Iterable[int]:
        tokens = self.older.get(piece)
        if tokens is not None:
            self[piece] = tokens
            return tokens
        transducer = Transducer(self.vocabulary)
        return [*transducer.feed(piece.encode()), *transducer.finish()]


class Encoder:
    """Texts to ids, window by window."""

    def __init__(self, vocabulary: Vocabulary, window: int = WINDOW):
        self.vocabulary, self.known, self.window = vocabulary, _Known(vocabulary), max(window, 8)
        names = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None

    def ids(self, text: str) -> Iterator[int]:
        """Ids of a text; the strings of added tokens count as these tokens."""
        for part in self._parts(text):
            if isinstance(part, list):
                self.known.learn(part)
            yield from self._tokens(part)

    def ids_of_all(self, texts: list[str]) -> Iterator[Iterable[int]]:
        """Ids of several texts; the pieces of those within a window are learned together."""
        parts = [list(self._parts(text)) if len(text) <= self.window else None for text in texts]
        self.known.learn(chain.from_iterable(p for some in parts if some for p in some if isinstance(p, list)))
        for text, some in zip(texts, parts):
            yield self.ids(text) if some is None else chain.from_iterable(map(self._tokens, some))

    def _tokens(self, part: list[str] | Iterable[int]) -> Iterable[int]:
        return chain.from_iterable(map(self.known.__getitem__, part)) if isinstance(part, list) else part

    def _parts(self, text: str) -> Iterator[list[str] | Iterable[int]]:
        """Lists of whole pieces, and ids of what is no piece or too long for one."""
        at = 0
        for found in self.added.finditer(text) if self.added else ():
            yield from self._part(text, at, found.start())
            yield (self.vocabulary.added[found.group()],)
            at = found.end()
        yield from self._part(text, at, len(text))

    def _part(self, text: str, at: int, end: int) -> Iterator[list[str] | Iterable[int]]:
        """Parts of ``text[at:end]``, which ends there for the pattern as well."""
        run, open_piece = None, Transducer(self.vocabulary)
        while at < end:
            stop = min(at + self.window, end)
            window = text[at:stop]
            if run is not None:
                reach = RUNS[run].match(window).end()
                more = reach == len(window) and stop < end
                # The last of several spaces belongs to what follows them.
                taken = reach - 1 if run == SPACE and at + reach < end else reach
                yield open_piece.feed(window[:taken].encode())
                at += taken
                if not more:
                    yield tuple(open_piece.finish())
                    run = None
                continue
            newest = np.frombuffer(window.encode("utf-16-le"), np.uint16).max()
            pieces = (OLD_PIECES if newest < FIRST_NEW else PIECES).findall(window)
            at = stop
            if stop < end:
                last = pieces.pop()
                if not pieces:
                    run = next(kind for kind, pattern in RUNS.items() if pattern.match(last[-1]).end())
                    part = last[:-1] if run == SPACE else last
                    yield open_piece.feed(part.encode())
                    at -= len(last) - len(part)
                    continue
                at -= len(last)
                if pieces[-1] == "'" and len(last) == 1:
                    # May become a contraction of two letters.
                    at -= len(pieces.pop())
            yield pieces


class Decoder:
    """Ids in, text out; bytes of an unfinished character wait for the next ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of, self.held = vocabulary.bytes_of, b""

    def feed(self, ids: list[int], last: bool = False) -> str:
        """Text of the ids so far; bytes that are no UTF-8 become U+FFFD. Unknown ids give nothing."""
        data = self.held + b"".join(map(self.bytes_of.get, ids, repeat(b"")))
        text, used = codecs.utf_8_decode(data, "replace", last)
        self.held = data[used:]
        return text


def load(df: DataFrame, path: str):
    """The tokenizer file at ``path``, sent to every task once."""
    with open(path, "rb") as file:
        content = file.read(FILE_BYTES + 1)
    if len(content) > FILE_BYTES:
        raise ValueError(f"{path} has more than {FILE_BYTES} bytes")
    Vocabulary(content)  # refuses a file of another kind before any task starts
    return df.sparkSession.sparkContext.broadcast(content)


_vocabularies: dict[bytes, Vocabulary] = {}


def _vocabulary(content: bytes) -> Vocabulary:
    """The parsed file; a worker process keeps the last one between tasks."""
    if content not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[content] = Vocabulary(content)
    return _vocabularies[content]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the ids of every text under the tokenizer file at ``path``.

    Ids are those that the public library gives without special tokens around them;
    the string of an added token inside a text is that token. A null or empty text
    has no ids. Rows are independent: repeated rows give repeated results, rows
    without id are encoded as well, an empty table gives none. Other columns are not
    read, so their names do not matter. A text is read in windows, so next to the text
    and its ids a task holds a window, one block of bytes and the pieces it remembers,
    however long the text or one of its words is.
    """
    sent = load(docs, path)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value)
        for start, texts in text_blocks(batch, "text"):
            ids, ends = array("i"), [0]
            for found in encoder.ids_of_all([(text or b"").decode("utf-8", "replace") for text in texts]):
                ids.extend(found)
                ends.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(texts)), lists], names=["doc_id", "ids"])

    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(plain, run, "doc_id bigint, ids array<int>")


_encoders: dict[int, Encoder] = {}


def _encoder(content: bytes) -> Encoder:
    """An encoder with the pieces that earlier tasks of this worker have met."""
    vocabulary = _vocabulary(content)
    if id(vocabulary) not in _encoders:
        _encoders.clear()
        _encoders[id(vocabulary)] = Encoder(vocabulary)
    return _encoders[id(vocabulary)]


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, ids, decoded)``: the text of every list of ids, special tokens included.

    Null and empty lists give an empty text. Ids that the file does not know, and null
    ids, give nothing; bytes that are no UTF-8 become U+FFFD. Rows are independent, as
    in ``encode``; other columns are not read.
    """
    sent = load(rows, path)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(sent.value)
        for row in range(batch.num_rows):
            ids = batch.column("ids")[row].values
            decoder, parts = Decoder(vocabulary), []
            for at in range(0, len(ids) if ids is not None else 0, WINDOW):
                # Without nulls the ids are numbers in a row, which become a list at once.
                parts.append(decoder.feed(ids.slice(at, WINDOW).drop_null().to_numpy().tolist()))
            parts.append(decoder.feed([], last=True))
            text = pa.array(["".join(parts)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(row, 1), batch.column("ids").slice(row, 1), text],
                names=["doc_id", "ids", "decoded"],
            )

    plain = rows.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return map_batches(plain, run, "doc_id bigint, ids array<int>, decoded string")
