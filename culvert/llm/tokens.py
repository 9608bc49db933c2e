"""Token ids of whole texts by the tokenizers library, with a cache of words."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a worker remembers, some 30 bytes each: beyond twice as many, those asked
#: for last stay.
CACHE_WORDS = 250_000
#: Bytes of a word that is remembered.
WORD_BYTES = 64
#: Texts that are looked up together, and their bytes; one longer text goes by itself.
TEXTS = 1 << 20
TEXT_BYTES = 4 << 20
#: Unknown words are joined to texts of this many; the tokenizer takes longer for each in longer ones.
JOINED = 100
#: Bytes that go to the tokenizer at a time; what it returns is some hundred bytes a token.
ASKED_BYTES = 256 << 10

BLANK = 0x20

#: Kinds of characters to the byte-level pattern: letters and digits, marks, white space. Blanks
#: and apostrophes, which join what is beside them, are of none.
ALNUM, MARK, SPACE, JOINING, UNASKED = 1, 2, 4, 0, 8
#: Whether the pattern always ends a piece between two kinds, as 8 * first + second.
_ENDS = np.zeros(256, bool)
_ENDS[[8 * a + b for a, b in ((ALNUM, MARK), (MARK, ALNUM), (ALNUM, SPACE), (MARK, SPACE))]] = True


class _Edges(dict):
    """Whether a text may be cut at a blank beside the character."""

    def __missing__(self, char: str) -> bool:
        self[char] = found = char.isprintable() and not char.isspace()
        return found


_EDGES = _Edges()
_ASCII = np.array([i < 0x80 and _EDGES[chr(i)] for i in range(256)])


def _slices(strings: pa.Array, rows: int, size: int) -> Iterator[slice]:
    """Runs of strings, each of at most so many and so many bytes, or of one string."""
    ends = np.cumsum(pc.binary_length(strings).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(strings):
        before = ends[start - 1] if start else 0
        stop = min(start + rows, int(np.searchsorted(ends, before + size, "right")))
        yield slice(start, stop := max(start + 1, stop))
        start = stop


def portions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in their order, as many at a time as ``Encoder.lists`` looks up together,
    however they come."""
    waiting, rows, size = [], 0, 0
    for batch in batches:
        for run in _slices(batch.column("text"), TEXTS, TEXT_BYTES):
            part = batch.slice(run.start, run.stop - run.start)
            more = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if waiting and (rows + part.num_rows > TEXTS or size + more > TEXT_BYTES):
                yield pa.concat_batches(waiting)
                waiting, rows, size = [], 0, 0
            waiting.append(part)
            rows, size = rows + part.num_rows, size + more
    if waiting:
        yield pa.concat_batches(waiting)


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings without nulls, and where each begins; then the end."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def _strings(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """What ``data`` holds from each start up to the next."""
    buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.string(), len(starts) - 1, buffers)


def _edges(data: np.ndarray, at: np.ndarray, *, ends: bool) -> np.ndarray:
    """Whether the character that begins or ``ends`` at each place is an edge."""
    found = _ASCII[data[at]]
    wide = np.flatnonzero(data[at] >= 0x80)
    first = at[wide]
    if ends:  # back to the first byte of the character
        for _ in range(3):
            first = first - (data[first] & 0xC0 == 0x80)
    lead = data[first]
    size = 2 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
    code = np.zeros(len(first), np.int64)
    for i in range(4):  # the bytes of a character as one number
        inside = i < size
        code[inside] = code[inside] << 8 | data[first[inside] + i]
    codes, which = np.unique(code, return_inverse=True)
    chars = [c.to_bytes(4, "big").lstrip(b"\0").decode() for c in codes.tolist()]
    found[wide] = np.array([_EDGES[c] for c in chars], bool)[which]
    return found


class _Known:
    """Words with their ids, and the time each was asked for last."""

    def __init__(self, dtype: np.dtype):
        self.words = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.from_numpy_dtype(dtype)))
        self.asked, self.time = np.zeros(0, np.int64), 0

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each word stands, -1 for those that are not known. Few words are not looked
        for among many: encoding them takes less time."""
        self.time += 1
        if 16 * len(words) < len(self.words):
            return np.full(len(words), -1)
        found = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        self.asked[found[found >= 0]] = self.time
        return found

    def add(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where they stand."""
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        self.words = pa.concat_arrays([self.words, words])
        self.ids = pa.concat_arrays([self.ids, pa.ListArray.from_arrays(offsets, pa.array(ids))])
        self.asked = np.concatenate([self.asked, np.full(len(words), self.time)])
        return np.arange(len(self.words) - len(words), len(self.words))

    def forget(self, most: int) -> None:
        """When there are twice too many words or bytes: long words, and those of long ago."""
        if len(self.words) <= 2 * most and self.words.nbytes <= 2 * most * WORD_BYTES:
            return
        short = pc.binary_length(self.words).to_numpy() <= WORD_BYTES
        keep = np.sort(np.argsort(np.where(short, -self.asked, 1), kind="stable")[:most])
        keep = keep[short[keep]]
        self.words, self.ids = self.words.take(pa.array(keep)), self.ids.take(pa.array(keep))
        self.asked = self.asked[keep]


class Encoder:
    """Ids as ``tokenizer.encode(text, add_special_tokens=False)`` gives them.

    The byte-level pattern ends a piece before every blank that stands between two other
    characters, so what such blanks separate can be encoded by itself, and words recur. A
    word keeps the blank in front of it. At blanks beside other white space a text is not
    cut, and nowhere if it holds the start of a special token. The pattern also ends a piece
    between letters or digits and marks, and before white space behind them, so "word,"
    and "word." share their word; apostrophes may begin a piece with letters in it.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.starts = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.starts[number] = token.startswith("Ġ")
        self.known = _Known(self.dtype)
        self.rule = self.tokenizer.pre_tokenizer
        pattern = isinstance(self.rule, pre_tokenizers.ByteLevel) and self.rule.use_regex
        plain = pattern and not self.rule.add_prefix_space and self.tokenizer.normalizer is None
        self.kinds = np.full(0x110000, UNASKED if plain else JOINING, np.uint8)

    def _kind(self, char: str) -> int:
        """The tokenizer tells it: characters of one kind are one piece."""
        if char in " '":
            return JOINING
        for other, kind in (("a", ALNUM), ("1", ALNUM), ("!", MARK)):
            if len(self.rule.pre_tokenize_str(other + char)) == 1:
                return kind
        return SPACE

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        """Kinds of characters by their numbers."""
        found = self.kinds[codes]
        if (found == UNASKED).any():
            for code in np.unique(codes[found == UNASKED]).tolist():
                self.kinds[code] = self._kind(chr(code))
            found = self.kinds[codes]
        return found

    def _ends(self, data: np.ndarray) -> np.ndarray:
        """Where a kind ends and the pattern its piece."""
        kinds = self._kinds(data & 0x7F)
        lead = np.flatnonzero(data >= 0xC0)
        size = 2 + (data[lead] >= 0xE0).astype(np.uint8) + (data[lead] >= 0xF0)
        code = data[lead].astype(np.int32) & (0x7F >> size)
        for i in range(1, 4):
            inside = i < size
            code[inside] = code[inside] << 6 | data[lead[inside] + i] & 0x3F
        wide = self._kinds(code)
        for i in range(4):  # all bytes of a character are of its kind
            inside = i < size
            kinds[lead[inside] + i] = wide[inside]
        pairs = kinds[:-1] << 3 | kinds[1:]
        found = np.append(False, _ENDS[pairs])[: len(data)]
        # One white space is a piece, of several the last is one if anything follows.
        after = np.flatnonzero((pairs == 8 * SPACE + ALNUM) | (pairs == 8 * SPACE + MARK))
        found[after + 1] = found[after]
        return found

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """What the tokenizer gives for the texts as they are, and the number of each."""
        ids = [np.zeros(0, self.dtype)]
        for run in _slices(texts, TEXTS, ASKED_BYTES):
            found = self.tokenizer.encode_batch_fast(texts[run].to_pylist(), add_special_tokens=False)
            ids += [np.array(x.ids, self.dtype) for x in found]
        return np.concatenate(ids), np.array([len(x) for x in ids[1:]], np.int64)

    def _joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words stand side by side in their buffer, each behind its blank, so each begins with
        the one token of its own that starts with a blank, whatever marks or line ends are
        inside."""
        data, at = _bytes_of(words)
        bounds = np.append(np.arange(0, len(words), JOINED), len(words))
        ids, sizes = self._whole(_strings(data, at[bounds]))
        cuts, ends = np.flatnonzero(self.starts[ids]), np.cumsum(sizes)
        if np.array_equal(np.searchsorted(cuts, ends), bounds[1:]) and self.starts[ids[ends - sizes]].all():
            return ids, np.diff(cuts, append=len(ids))
        return self._whole(words)  # another vocabulary may not mark the blank, or cut it off

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Where the words stand among the known from now on."""
        data, at = _bytes_of(words)
        first, last = at[:-1], at[1:] - 1
        blanks = np.concatenate([[0], np.cumsum(data == BLANK)])
        plain = (data[first] == BLANK) & (blanks[at[1:]] - blanks[first] == 1) & (last > first)
        plain[plain] = _edges(data, first[plain] + 1, ends=False) & _edges(data, last[plain], ends=True)
        places = np.zeros(len(words), np.int64)
        for some, encoded in ((plain, self._joined), (~plain, self._whole)):
            if some.any():
                part = words.filter(pa.array(some))
                places[some] = self.known.add(part, *encoded(part))
        return places

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """What stands between the cuts, and how many of them each text has."""
        data, at = _bytes_of(texts)
        filled = np.flatnonzero(np.diff(at))
        cut = data == BLANK
        cut[at[filled]] = cut[at[filled + 1] - 1] = False
        blanks = np.flatnonzero(cut)
        cut[blanks] = _edges(data, blanks - 1, ends=True) & _edges(data, blanks + 1, ends=False)
        cut |= self._ends(data)
        for start in {s[:2] for s in self.special}:
            for i in np.flatnonzero(pc.match_substring(texts, start).to_numpy(zero_copy_only=False)).tolist():
                cut[at[i] : at[i + 1]] = False
        cut[at[filled]] = True
        starts = np.append(np.flatnonzero(cut), len(data))
        return _strings(data, starts), np.diff(np.searchsorted(starts, at))

    def _lists(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, counts = self._words(texts)
        # Every distinct word is looked up once, and its ids are put in its places.
        found = words.dictionary_encode()
        places = self.known.places(found.dictionary)
        new = places < 0
        places[new] = self._learn(found.dictionary.filter(pa.array(new)))
        lists = self.known.ids.take(pa.array(places[found.indices.to_numpy()]))
        self.known.forget(CACHE_WORDS)
        ends = lists.offsets.to_numpy()[np.concatenate([[0], np.cumsum(counts)])]
        return lists.values.to_numpy()[ends[0] : ends[-1]], np.diff(ends).astype(np.int64)

    def lists(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and how many each has; a null text has
        none."""
        ids, sizes = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for run in _slices(texts, TEXTS, TEXT_BYTES):
            found = self._lists(texts[run].cast(pa.string()).fill_null(""))
            ids.append(found[0])
            sizes.append(found[1])
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of each text, of ``self.dtype``; a null text has none."""
        ids, sizes = self.lists(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes)
        return [ids[e - n : e].tobytes() for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)


def vocabulary(name: str) -> str:
    """The place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)
