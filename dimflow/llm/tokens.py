"""Ids of many texts at once, by the tokenizers library.

Both public BPE vocabularies cut a text into pieces before any merge, and never
merge across a cut.  A single space between two characters that are no white
space is always such a cut.  A slice of texts is therefore split at spaces, its
distinct words are cut into pieces by one pattern search, and the ids of the
texts are put together by one numpy gather.  The ids of pieces are remembered per
Python worker, in a bounded dictionary.

Where the ids of a vocabulary rise in the order of its merges, they serve as ranks
of merges, and the words or pieces go through tiktoken, which merges by rank.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

#: Letters, numbers and white space up to U+012F, where normal
#: form C changes nothing and lower case depends on no neighbour.
LATIN_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-į"
LATIN_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
WHITE_SPACE = "\t-\r \x85\xa0"
#: The cut patterns of the two vocabularies, for such characters.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
MARK = "\x1f"  # stands between the words of a slice; a piece of its own
BYTE_PIECES = re.compile(
    f"{MARK}|{CONTRACTIONS}| ?[{LATIN_LETTERS}]+| ?[{LATIN_NUMBERS}]+"
    f"| ?[^{MARK}{WHITE_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+"
    f"|[{WHITE_SPACE}]+(?![^{MARK}{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
WORD_PIECES = re.compile(
    f"{MARK}|{CONTRACTIONS}|[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]"
    f"|[^{MARK}{WHITE_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+"
)
#: Fixed value: the cut pattern of the byte-level vocabulary, for all characters.
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
FEED = "\x0c"  # stands between the words of a slice that is encoded at once
#: All that Python calls white space up to U+012F.
SPACE_LETTERS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
#: White space beside a mark, but for the space that begins a word, and empty words.
BESIDE = [s + FEED for s in SPACE_LETTERS] + [
    FEED + c + s for s in SPACE_LETTERS for c in ("", " ") if c + s != " "
]
SPACE_AT_END = re.compile(r"\A(?:\s(?!\S)|[^\S ]|\Z)|\s\Z")
NOT_LATIN = re.compile("[^\x00-į]")
#: A space beside white space or an end: no cut.  All that Python calls white space.
SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACE_RUN = f"^ | $|{SPACES} | {SPACES}"
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")

REMEMBERED = 600_000
SLICE_BYTES = 6 << 20  # of text that is put together at a time


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class Remembered(dict):
    """Values by key, computed on first use.  When ``most`` keys are held they
    become the old half; what is not used again goes with the next change."""

    def __init__(self, compute, most: int):
        super().__init__()
        self._compute, self._most, self._old = compute, most, {}

    def __missing__(self, key):
        if len(self) >= self._most:
            self._old = dict(self)
            self.clear()
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        self[key] = value
        return value


class Pieces:
    """Words to ids by way of pieces.  ``piece`` gives the ids of a piece as
    bytes, ``whole`` those of any text that the pattern does not fit."""

    def __init__(self, pattern: re.Pattern, lower: bool, specials: list[str], dtype, piece, whole):
        self._find, self._lower, self._specials = pattern.findall, lower, specials
        self.dtype, self.known, self._whole = dtype, Remembered(piece, REMEMBERED), whole
        self.known[MARK] = b""

    def _odd(self, text: str) -> bool:
        return bool(NOT_LATIN.search(text)) or any(s in text for s in self._specials)

    def ids(self, bare: list[str], spaced: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in one array, with start and number of each word's.
        ``spaced`` words come last and have a space before them."""
        text, odd, rest = self._joined(bare, spaced), [], []
        n = len(bare) + len(spaced)
        if self._odd(text) or text.count(MARK) != n - 1:
            words = bare + [" " + w for w in spaced]
            odd = [i for i, w in enumerate(words) if MARK in w or self._odd(w)]
            rest = [self._whole(words[i]) for i in odd]
            for i in odd:
                words[i] = ""
            text = self._joined(words, [])
        found = self._find(text.lower() if self._lower else text)
        self.known.setdefault(MARK, b"")
        values = list(map(self.known.__getitem__, found))
        size = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        word = np.cumsum(size == 0)  # only the mark has no ids
        sizes = np.bincount(word, size, minlength=n).astype(np.int64)[:n]
        starts = np.cumsum(sizes) - sizes
        if odd:
            at = int(sizes.sum())
            sizes[odd] = [len(x) // self.dtype.itemsize for x in rest]
            starts[odd] = at + np.cumsum(sizes[odd]) - sizes[odd]
            values += rest
        return np.frombuffer(b"".join(values), self.dtype), starts, sizes

    @staticmethod
    def _joined(bare: list[str], spaced: list[str]) -> str:
        second = [" " + f"{MARK} ".join(spaced)] if spaced else []
        return MARK.join(bare + second)


class Words:
    """Words to ids of a byte-level vocabulary, all words of a slice in one call.

    A form feed stands between the words: white space that has none beside it is a
    piece of its own.  Words with white space at an end, with a form feed, with
    letters beyond the pattern's or with special tokens go to ``whole`` one by one.
    """

    def __init__(self, ranks: dict[bytes, int], specials: list[str], dtype, whole):
        name = f"dimflow-{len(ranks)}"
        self._encode = tiktoken.Encoding(
            name, pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._mark, self._specials, self.dtype, self._whole = ranks[FEED.encode()], specials, dtype, whole

    def _odd(self, text: str) -> bool:
        return bool(NOT_LATIN.search(text)) or any(s in text for s in self._specials)

    def ids(self, bare: list[str], spaced: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`Pieces.ids`."""
        words, odd = bare + [" " + w for w in spaced], []
        text = FEED.join(words)
        if (
            self._odd(text)
            or text.count(FEED) != len(words) - 1
            or any(s in text for s in BESIDE)
            or any(SPACE_AT_END.search(w) for w in words[:1] + words[-1:])
        ):
            odd = [i for i, w in enumerate(words) if FEED in w or SPACE_AT_END.search(w) or self._odd(w)]
            rest = [self._whole(words[i]) for i in odd]
            for i in odd:
                words[i] = "a"
            text = FEED.join(words)
        found = np.array(self._encode(text), self.dtype)
        marks = np.flatnonzero(found == self._mark)
        starts = np.concatenate([[0], marks + 1])[: len(words)]
        sizes = np.append(marks, len(found))[: len(words)] - starts
        if odd:
            sizes[odd] = [len(x) // self.dtype.itemsize for x in rest]
            starts[odd] = len(found) + np.cumsum(sizes[odd]) - sizes[odd]
            found = np.concatenate([found, np.frombuffer(b"".join(rest), self.dtype)])
        return found, starts, sizes


def merge_ranks(form: dict, letters: list[str]) -> dict[bytes, int] | None:
    """Ids by the bytes of their tokens, if the ids of the merged tokens rise in the
    order of the merges, so that they rank these.  Of a vocabulary with word ends, a
    token that ends a word has 128 added to its last byte, and only ASCII tokens are
    there."""
    model = form["model"]
    vocab, ending = model["vocab"], model.get("end_of_word_suffix") or ""
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocab.get("".join(p)) for p in pairs]
    if None in made or any(a >= b for a, b in zip(made, made[1:], strict=False)):
        return None
    byte_of, ranks = {c: i for i, c in enumerate(letters)}, {}
    specials = {t["content"] for t in form["added_tokens"]}
    for token, at in vocab.items():
        whole = bool(ending) and token.endswith(ending)
        body = token.removesuffix(ending) if whole else token
        if token in specials or any(c not in byte_of for c in body):
            continue
        raw = bytes(byte_of[c] for c in body)
        if ending and not raw.isascii():
            continue
        ranks[raw[:-1] + bytes([raw[-1] | 128]) if whole else raw] = at
    return ranks if all(bytes([b]) in ranks for b in range(256)) else None


class Single:
    """Ids of one text or piece as bytes.  It does not know the encoder whose pieces
    call it, so that an encoder goes with its last user and not with a later garbage
    collection: a Python worker would else gather those of its tasks."""

    def __init__(self, tokenizer: Tokenizer, dtype: np.dtype, letters: list[str], merge=None):
        self._tokenizer, self._dtype, self._letters, self._merge = tokenizer, dtype, letters, merge

    def whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self._dtype).tobytes()

    def ranked_piece(self, piece: str) -> bytes:
        if not piece.isascii():
            return self.piece(piece)
        raw = piece.encode()
        kind = "H" if self._dtype.itemsize == 2 else "I"
        return array(kind, self._merge(raw[:-1] + bytes([raw[-1] | 128]))).tobytes()

    def piece(self, piece: str) -> bytes:
        word = piece.removeprefix(" ")
        if word.isascii() and word.isalpha():
            letters = piece.replace(" ", self._letters[32])
        else:
            letters = "".join(map(self._letters.__getitem__, piece.encode()))
        ids = [t.id for t in self._tokenizer.model.tokenize(letters)]
        return array("H" if self._dtype.itemsize == 2 else "I", ids).tobytes()


class Encoder:
    """Ids of texts by a vocabulary file, as ``Tokenizer.encode`` returns them
    without added special tokens, truncation or padding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        form["truncation"] = form["padding"] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(form))
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.drops_spaces = form["normalizer"] is not None
        letters = byte_letters()
        specials = [t["content"] for t in form["added_tokens"]]
        ranks = merge_ranks(form, letters)
        if ranks and not self.drops_spaces:
            single = Single(self.tokenizer, self.dtype, letters)
            self.pieces = Words(ranks, specials, self.dtype, single.whole)
            return
        merge = None
        if ranks:
            merge = tiktoken.Encoding(
                "dimflow-words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}
            )._core_bpe.encode_single_piece
        single = Single(self.tokenizer, self.dtype, letters, merge)
        self.pieces = Pieces(
            WORD_PIECES if self.drops_spaces else BYTE_PIECES,
            self.drops_spaces,
            specials,
            self.dtype,
            single.ranked_piece if ranks else single.piece,
            single.whole,
        )

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text.
        Null texts count as empty."""
        return gather(texts, self.pieces, self.drops_spaces)

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        _, _, counts, offsets = located(texts, self.pieces, self.drops_spaces)
        return np.diff(np.concatenate([[0], np.cumsum(counts)])[offsets])


def slices(batch: pa.RecordBatch, column: str) -> list[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``SLICE_BYTES`` of text; a longer text
    stands alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    group = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = np.flatnonzero(np.diff(group)) + 1
    return [
        batch.slice(a, b - a)
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True)
        if b > a
    ]


def gather(texts: pa.Array, pieces: Pieces, drops_spaces: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array and the number of ids of each text."""
    pool, starts, counts, offsets = located(texts, pieces, drops_spaces)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
    places = np.repeat((starts - (ends - counts)).astype(kind), counts)
    places += np.arange(total, dtype=kind)
    return pool[places], np.diff(np.concatenate([[0], ends])[offsets])


def located(texts: pa.Array, pieces: Pieces, drops_spaces: bool):
    """Ids of the distinct words, the place and number of ids of each word of the
    texts, and the words that each text begins and ends with.

    A word is what stands between two single spaces, with the space before it.
    Where ``drops_spaces`` is false, a space that has white space beside it is
    no cut.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.split_pattern(texts, " ")
    offsets = np.asarray(split.offsets)
    coded = split.flatten().dictionary_encode()
    codes = np.asarray(coded.indices).astype(np.int64)
    words = coded.dictionary.to_pylist()
    bare = words
    if not drops_spaces:
        codes, offsets, bare = cut_with_spaces(texts, codes, offsets, words)
    pool, starts, sizes = pieces.ids(bare, [] if drops_spaces else words)
    return pool, starts[codes], sizes[codes], offsets


def cut_with_spaces(texts, codes, offsets, words):
    """Codes of the words of the texts, where bare words come before those with a
    space before them.  The first word of a text is bare; texts with runs of white
    space are cut anew, at safe spaces only."""
    first, own = np.unique(codes[offsets[:-1]], return_inverse=True)
    rows = np.flatnonzero(pc.match_substring_regex(texts, SPACE_RUN))
    bare = [words[i] for i in first.tolist()]
    recut = [SAFE_CUT.split(texts[row].as_py()) for row in rows.tolist()]
    begin = len(bare)
    for new in recut:
        bare += [" " + w if i else w for i, w in enumerate(new)]
    codes = codes + len(bare)
    codes[offsets[:-1]] = own
    parts, sizes, last = [], np.diff(offsets), 0
    for row, new in zip(rows.tolist(), recut, strict=True):
        parts += [codes[offsets[last] : offsets[row]], np.arange(begin, begin + len(new))]
        begin += len(new)
        sizes[row] = len(new)
        last = row + 1
    parts.append(codes[offsets[last] :])
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)]), bare
