"""SentencePiece encoding and decoding by streaming Viterbi, for models of merge type with byte fallback.

A text gets one space in front and its spaces become U+2581, as the models here ask for; nothing else is normalised. For
each position of a stretch of text the search keeps one back-pointer: the last piece of the encoding of everything before.
In a merge model the encoding of a prefix is unique, and a row of pieces is an encoding exactly if each piece and each pair
of neighbours encodes to itself, so a back-pointer is the one piece that ends here and agrees with the back-pointer where
it starts. (Adding up the scores of a merge model would give other ids than the library's; that is why agreement, not a sum,
picks the path.) Only the last `longest` positions can still be reached by a piece, so the window is that long; whenever the
paths from all of them pass one boundary, the ids before it are committed and forgotten.

Paths also meet, for every text, where no piece of the vocabulary can reach across: before a run of U+2581, around a
character that no piece holds, and between a letter and a mark that follows letters in no piece. Texts are cut there first.
The words of a step of texts that the worker has not met lately are searched all at once: each round of the search goes one
character on in every word, with the back-pointers of all words in one array. A word is shorter than a window, so its path is
read off at its end; longer stretches are streamed. What a worker has seen it takes from bounded caches: the words met last
as strings, stretches and pairs of pieces in flat arrays.

Rules. Null text and empty text give no ids. A character without a piece becomes its UTF-8 bytes. Decoding gives back the
text; U+2581 in a text comes back as a space, as in the library. Repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import STEP_BYTES, arrow_map, steps, table

SPACE = "\u2581"

#: A space between two words of a line.
BETWEEN = regex.compile(r"(?<=[^ \n\u2581]) (?=[^ \n\u2581])")

#: Characters that one search takes, about, so that its arrays stay small.
PER_SEARCH = 1 << 16


class Vocabulary:
    """Pieces, scores and byte ids of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * size
        self.byte_id = [0] * 256
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.ids), default=1)
        if any(regex.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece of this model spans a word boundary")
        self.cuts = self._cuts()

    def _cuts(self) -> regex.Pattern:
        """Stretches that no piece reaches across."""
        held = set("".join(self.ids))
        alone = "".join(chr(c) for c in range(0x250) if chr(c) not in held and chr(c) != " ")
        after = {p[i] for p in self.ids for i in range(1, len(p)) if p[i - 1].isalpha()}
        marks = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in after)
        alone, marks = regex.escape(alone) or r"\x00", regex.escape(marks)
        return regex.compile(
            rf"[{alone}]|{SPACE}*+\p{{L}}++(?=[{marks}{SPACE}{alone}]|$)|{SPACE}*+[^{SPACE}{alone}]++|{SPACE}++"
        )


class Places:
    """Ids of short strings in flat arrays, one place for each hash, 41 bytes a place: a new string takes the place of an
    older one with the same last bits. Strings are not kept: ids count if their pieces spell the string asked for."""

    LONGEST = 8

    def __init__(self, size: int, text_of: list[str]):
        n = 1 << max(size - 1, 1).bit_length()
        self._mask, self._text_of = n - 1, text_of
        self._hashes, self._counts, self._ids = array("q", bytes(8 * n)), bytearray(n), array("i", bytes(4 * self.LONGEST * n))

    def get(self, hashed: int, text: str) -> bytes | None:
        place = hashed & self._mask
        if self._hashes[place] != hashed:
            return None
        at = place * self.LONGEST
        ids = self._ids[at : at + self._counts[place]]
        return ids.tobytes() if "".join([self._text_of[i] for i in ids]) == text else None

    def put(self, hashed: int, ids: bytes) -> None:
        count = len(ids) >> 2
        if count <= self.LONGEST:
            place = hashed & self._mask
            at = place * self.LONGEST
            self._hashes[place], self._counts[place], self._ids[at : at + count] = hashed, count, array("i", ids)


class Numbers:
    """A small number for each key from 0 on, in flat arrays, asked for many keys at once. An array twice the room at least;
    a key takes the first free place from its hash on. When `room` keys are in, the next ones start anew."""

    def __init__(self, room: int, dtype: type):
        n = 1 << max(2 * room - 1, 1).bit_length()
        self._room, self._mask, self._shift, self._held = room, n - 1, np.uint64(64 - n.bit_length() + 1), 0
        self._keys, self._values = np.full(n, -1, np.int64), np.zeros(n, dtype)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for one that is not in."""
        places = self._places(keys)
        held = self._keys[places]
        values = np.where(held == keys, self._values[places], self._values.dtype.type(-1))
        left = np.flatnonzero((held != keys) & (held >= 0))
        while left.size:
            places[left] = (places[left] + 1) & self._mask
            held = self._keys[places[left]]
            right = held == keys[left]
            values[left[right]] = self._values[places[left[right]]]
            left = left[~right & (held >= 0)]
        return values

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Take in different keys that are not in yet."""
        for at in range(0, len(keys), self._room):
            part, numbers = keys[at : at + self._room], values[at : at + self._room]
            if self._held + len(part) > self._room:
                self._keys.fill(-1)
                self._held = 0
            self._held += len(part)
            places = self._places(part)
            while len(part):
                free = np.flatnonzero(self._keys[places] < 0)
                self._keys[places[free]] = part[free]
                done = self._keys[places] == part
                self._values[places[done]] = numbers[done]
                part, numbers, places = part[~done], numbers[~done], (places[~done] + 1) & self._mask


class Coder:
    """Encodes and decodes with one vocabulary. Caches are bounded by `cache`: so many stretches up to the next power of two
    have a place of 41 bytes, at most a third as many words, and those of one step, are kept as strings (about 200 bytes each),
    and so many pairs of pieces twice: those of words (18 to 36 bytes each) and those of streamed stretches (about 90 each)."""

    def __init__(self, path: str, cache: int = 400_000):
        self.vocabulary = Vocabulary(path)
        self._bound = cache
        #: Words met last, and those of the step in hand. When the first is full it becomes the second; the second is forgotten.
        self._words: dict[str, bytes] = {}
        self._words_before: dict[str, bytes] = {}
        self._agrees: dict[int, bool] = {}
        self._edges: dict[str, tuple | None] = {}
        scores = self.vocabulary.scores
        #: Pieces that encode to themselves, a character a step: each node has the next ones, and under "" the id of the piece
        #: that ends there.
        self._pieces: dict = {}
        self._text_of: dict[int, str] = {}
        for piece in scores:
            if self._edge(piece):
                node = self._pieces
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = self.vocabulary.ids[piece]
                self._text_of[node[""]] = piece
        #: Streamed stretches, but not those with bytes of characters without a piece, which spell nothing.
        self._seen = Places(cache, [self._text_of.get(i, "") for i in range(len(self.vocabulary.bytes_of))])
        self._line_ends = "\n" not in "".join(scores)
        self._byte_ids = np.array(self.vocabulary.byte_id, np.int32)
        #: The same pieces for many words at once: number of a character, the node after a node and a character, the piece that
        #: ends at a node.
        held = sorted(set("".join(self._text_of.values())))
        self._number_of = np.zeros(max(map(ord, held), default=0) + 2, np.int32)
        self._number_of[[ord(c) for c in held]] = np.arange(1, len(held) + 1)
        self._width = len(held) + 1
        nodes, ways, self._ends_in = [self._pieces], [], []
        for number, node in enumerate(nodes):
            self._ends_in.append(node.get("", -1))
            for c, after in node.items():
                if c:
                    ways.append((number * self._width + int(self._number_of[ord(c)]), len(nodes)))
                    nodes.append(after)
        self._ends_in = np.array(self._ends_in, np.int32)
        self._ways = Numbers(max(len(ways), 1), np.int32)
        self._ways.put(*(x.copy() for x in np.array(ways, np.int64).reshape(-1, 2).T))
        self._first = self._ways.get(np.arange(self._width)).astype(np.int64)
        self._pairs = Numbers(max(cache, 1), np.int8)

    def _merged(self, text: str) -> tuple[list[str], list[tuple]]:
        """Merges of a short string, best score first, leftmost of equals; and (left part, right part, score, place) of each."""
        parts, scores, done = list(text), self.vocabulary.scores, []
        while len(parts) > 1:
            best = max(
                ((scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in scores),
                default=None,
            )
            if best is None:
                break
            i = -best[1]
            done.append((parts[i], parts[i + 1], best[0], i, i + 2 == len(parts)))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts, done

    def _edge(self, piece: str) -> tuple | None:
        """What stands at a piece's left and right end while it is merged: lists of (part, score it came with, score of the
        merge that used it up; none for the piece itself). Null if the piece does not encode to itself."""
        if piece not in self._edges:
            parts, merges = self._merged(piece)
            if len(parts) > 1:
                self._edges[piece] = None
            else:
                sides = []
                for at_end in (False, True):
                    part, came, side = piece[-1] if at_end else piece[0], float("inf"), []
                    for left, right, score, i, last in merges:
                        if last if at_end else i == 0:
                            side.append((part, came, score))
                            part, came = left + right, score
                    sides.append((*side, (part, came, float("-inf"))))
                self._edges[piece] = tuple(sides)
        return self._edges[piece]

    def _fits(self, both: int) -> bool:
        """Whether two pieces next to each other stay as they are (their ids in one number): no part at a's end merges with one
        at b's start. That happens if their merge scores better than the merges that use the two up (as well as b's: it is
        further left)."""
        a, b = self._text_of[both >> 32], self._text_of[both & 0xFFFFFFFF]
        known, scores = True, self.vocabulary.scores
        for x, x_came, x_used in self._edge(a)[1]:
            for y, y_came, y_used in self._edge(b)[0]:
                score = scores.get(x + y)
                if score is not None and score > x_used and score >= y_used:
                    # scores fall along merges in a trained model; where they don't, merge and see
                    known = False if score <= x_came and score <= y_came else self._merged(a + b)[0] == [a, b]
                    break
            if not known:
                break
        return known

    def _pair(self, both: int) -> bool:
        """Whether two pieces fit, kept for the next time."""
        if len(self._agrees) >= self._bound:
            self._agrees.clear()
        known = self._agrees[both] = self._fits(both)
        return known

    def _search(self, text: str, start: int, end: int, back: dict[int, int], last: dict[int, int]) -> None:
        """Go through the places from start to end: `back` gets where the last piece of the encoding of text[:i] starts,
        `last` its id, -1 for a character without a piece."""
        root, agrees, n = self._pieces, self._agrees, len(text)
        for at in range(start, end):
            if at not in back:
                back[at], last[at] = at - 1, -1
            before = last[at]
            node, to = root, at
            while to < n:
                node = node.get(text[to])
                if node is None:
                    break
                to += 1
                if "" in node and to not in back:
                    piece = node[""]
                    if before >= 0:
                        both = before << 32 | piece
                        fits = agrees.get(both)
                        if not (self._pair(both) if fits is None else fits):
                            continue
                    back[to], last[to] = at, piece

    def stream(self, text: str, check_every: int = 64):
        """Pieces of a stretch, committed as soon as every surviving path agrees on them."""
        n, base, back, last = len(text), 0, {0: 0}, {0: -1}
        for start in range(0, n, check_every):
            end = min(start + check_every, n)
            self._search(text, start, end, back, last)
            if end == n:
                break
            at = end - 1
            alive = {p for p in range(end, end + self.vocabulary.longest) if p in back} or {at}
            while len(alive) > 1:
                far = max(alive)
                alive.remove(far)
                alive.add(back[far])
            at = alive.pop()
            if base < at < end:
                yield from self._path(text, base, back, at)
                for i in range(base, at):
                    back.pop(i, None)
                    last.pop(i, None)
                back[at], base = max(back[at], base), at
        if n and n not in back:
            back[n] = n - 1
        yield from self._path(text, base, back, n)

    def _search_all(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of at most 64 characters, by one search for all, without commits. A place is a character or the end of a
        part; what is kept at it is about the text of its part before it. In round i each part goes on from its place i."""
        gap = "\0" + SPACE
        codes = np.frombuffer(gap.join(["", *parts, ""]).encode("utf-32-le"), np.uint32).astype(np.int32)
        codes[codes == 32] = ord(SPACE)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 2
        ends = np.cumsum(sizes)
        starts = ends - sizes + 1
        numbers = self._number_of[np.minimum(codes, len(self._number_of) - 1)]
        numbers[ends], numbers[-1] = 0, 0
        round_of = np.arange(len(codes))
        round_of[1:-1] -= np.repeat(starts, sizes)
        if self._line_ends:
            starts += codes[starts + 1] == 10
        # all pieces in all parts: at which place they start, and at which they end
        at = np.flatnonzero(numbers)
        node, found = self._first[numbers[at]], []
        for length in range(1, self.vocabulary.longest + 1):
            on = np.flatnonzero(node >= 0)
            at, node = at[on], node[on]
            piece = self._ends_in[node]
            here = np.flatnonzero(piece >= 0)
            found.append((at[here], at[here] + length, piece[here]))
            node = self._ways.get(node * self._width + numbers[at + length]).astype(np.int64)
        froms, tos, pieces = (np.concatenate(x) for x in zip(*found, strict=True))
        rounds = round_of[froms].astype(np.uint8)
        order = np.argsort(rounds, kind="stable")
        froms, tos, pieces = froms[order], tos[order], pieces[order]
        back, last = np.arange(-1, len(codes) - 1), np.full(len(codes), -1, np.int32)
        begin = 0
        for end in np.cumsum(np.bincount(rounds)).tolist():
            new = np.flatnonzero(last[tos[begin:end]] < 0) + begin
            new = new[self._agree(last[froms[new]], pieces[new])]
            back[tos[new]], last[tos[new]] = froms[new], pieces[new]
            begin = end
        # the paths, from the ends back; characters without a piece become their bytes
        on_path, first, at = np.zeros(len(codes), bool), np.zeros(len(codes), bool), ends
        first[starts] = True
        while at.size:
            on_path[at] = True
            at = back[at]
            at = at[~first[at]]
        places = np.flatnonzero(on_path)
        ids = last[places]
        alone = codes[places[ids < 0] - 1]
        sizes = np.ones(len(places), np.int64)
        sizes[ids < 0] += (alone >= 0x80).astype(np.int64) + (alone >= 0x800) + (alone >= 0x10000)
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(places, ends, side="right")] * 4
        ids = np.repeat(ids, sizes)
        ids[ids < 0] = self._byte_ids[np.frombuffer(alone.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)]
        packed, cuts = ids.tobytes(), cuts.tolist()
        return [*map(packed.__getitem__, map(slice, [0, *cuts[:-1]], cuts))]

    def _agree(self, before: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """Whether each piece fits behind the one before it; any does where there is none (-1)."""
        both = before.astype(np.int64) << 32 | pieces
        fits = self._pairs.get(np.maximum(both, 0))
        fits[before < 0] = 1
        asked = np.flatnonzero(fits < 0)
        if asked.size:
            new, where = np.unique(both[asked], return_inverse=True)
            known = np.array([self._fits(b) for b in new.tolist()], np.int8)
            self._pairs.put(new, known)
            fits[asked] = known[where]
        return fits > 0

    @staticmethod
    def _path(text: str, base: int, back: dict[int, int], to: int) -> list[str]:
        path = []
        while to > base:
            path.append(text[back[to] : to])
            to = back[to]
        return path[::-1]

    def _ids(self, stretch: str) -> bytes:
        """Ids of a stretch that no piece reaches out of."""
        known = self._seen.get(hash(stretch), stretch)
        if known is None:
            ids, of = [], self.vocabulary
            for piece in self.stream(stretch):
                if piece in of.ids:
                    ids.append(of.ids[piece])
                else:
                    ids.extend(of.byte_id[b] for b in piece.encode())
            known = np.asarray(ids, np.int32).tobytes()
            if len(stretch) <= 64:
                self._seen.put(hash(stretch), known)
        return known

    def _cut(self, text: str) -> bytes:
        """Ids of a text with its spaces replaced, cut into stretches."""
        return b"".join([self._ids(p) for p in self.vocabulary.cuts.findall(text)])

    def _parts(self, text: str) -> list[str]:
        """A text without its spaces: each part stands for a space and what follows it up to the next run of spaces, with the
        spaces beyond the first in front. A part that begins with a line's end stands for that alone and what follows."""
        text = text.replace(SPACE, " ")
        parts = (text.replace("\n", " \n") if self._line_ends else text).split(" ")
        if "" not in parts:
            return parts
        joined, blanks = [], 0
        for part in parts:
            if not part:
                blanks += 1
            elif blanks and self._line_ends and part[0] == "\n":
                joined += [" " * (blanks - 1), part]
                blanks = 0
            else:
                joined.append(" " * blanks + part)
                blanks = 0
        return joined + [" " * (blanks - 1)] * (blanks > 0)

    def _learn(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Parts with their ids."""
        short = [p for p in parts if len(p) <= 64]
        groups = 1 + sum(map(len, short)) // PER_SEARCH
        for group in filter(None, [short[i::groups] for i in range(groups)]):
            yield from zip(group, self._search_all(group), strict=True)
        for part in parts:
            if len(part) > 64:
                of_line = self._line_ends and part[0] == "\n"
                yield part, self._cut(part if of_line else SPACE + part.replace(" ", SPACE))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as packed 32-bit integers; the texts' new words are searched together."""
        rows = [self._parts(t) if t else [] for t in texts]
        words, before = self._words, self._words_before
        missing = set(itertools.chain.from_iterable(rows)).difference(words)
        new = missing.difference(before)
        words.update([(p, before[p]) for p in missing - new])
        words.update(self._learn([*new]))
        packed = [b"".join(map(words.__getitem__, parts)) for parts in rows]
        for part in [p for p in missing if len(p) > 64]:
            del words[part]
        if len(words) > self._bound // 6:
            self._words, self._words_before = {}, words
        return packed

    def encode(self, text: str | None) -> bytes:
        """Ids as packed 32-bit integers. A long text is cut at single spaces, where paths meet, and taken block by block."""
        text, packed, at = text or "", [], 0
        while len(text) - at > STEP_BYTES and (cut := BETWEEN.search(text, at + STEP_BYTES)):
            packed += self.encode_all([text[at : cut.start()]])
            at = cut.end()
        return b"".join([*packed, *self.encode_all([text[at:]])])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids.tolist()))[1:].decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def _coder(path: str, cache: int) -> Coder:
    """One coder for all tasks of a worker, with what it has seen."""
    return Coder(path, cache)


def encode(
    docs: DataFrame, path: str, *, check: bool = False, cache: int = 400_000, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """ids after the columns of `keep`: one row per row of docs. With `check` also same: whether decoding gives the text."""
    narrow = docs.select(*dict.fromkeys([*keep, "text"]))

    def run(batches):
        coder = _coder(path, cache)
        for batch in batches:
            for part in steps(batch):
                texts = part.column("text").to_pylist()
                packed = coder.encode_all(texts) if len(texts) > 1 else [coder.encode(t) for t in texts]
                ends = np.cumsum([0, *[len(p) // 4 for p in packed]], dtype=np.int32)
                flat = np.frombuffer(b"".join(packed), np.int32)
                columns = [*(part.column(c) for c in keep), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                names = [*keep, "ids"]
                if check:
                    want = [(t or "").replace(SPACE, " ") for t in texts]
                    same = [coder.decode(np.frombuffer(p, np.int32)) == t for p, t in zip(packed, want, strict=True)]
                    columns.append(pa.array(same, pa.bool_()))
                    names.append("same")
                yield pa.RecordBatch.from_arrays(columns, names)

    added = T.StructType.fromDDL("ids array<int>" + ", same boolean" * check)
    return narrow.mapInArrow(run, T.StructType(narrow.select(*keep).schema.fields + added.fields))


def decode(encoded: DataFrame, path: str, *, cache: int = 400_000) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids give null."""

    def run(batches):
        coder = _coder(path, cache)
        for batch in batches:
            ids = batch.column("ids")
            texts = [None if not x.is_valid else coder.decode(pc.cast(x.values, pa.int32()).to_numpy()) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return arrow_map(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")


def op10_piece_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded with piece_bpe_32k.model and decoded again."""
    import public_tokenizers

    coded = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), check=True)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.col("same").alias("round_trip"))
