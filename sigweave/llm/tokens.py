"""Token ids of whole texts by the tokenizers library, word by word with a bounded memory.

The vocabulary drops white space and never joins over it, so a text's ids are those of its
white-space separated words one after another. Words repeat, hence each worker keeps the ids
of words it has met and asks the library only for new ones. Where the vocabulary parts letters
from the signs behind them and has one case, the two are kept apart.
"""

from __future__ import annotations

import json
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
# A worker forgets its words beyond these numbers of words and ids.
MOST_WORDS = 600_000
MOST_IDS = 4_000_000
# New words that the library gets at once; its own records of a text are large.
ENCODE_WORDS = 8192
MARK = "|"
# Words of these characters keep their number of parts when they are normalised.
_STEADY = r"^[!-~\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+$"
# Of these letters each is one letter in lower case and in any normal form.
_LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+"
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# A vocabulary whose words part by this, after these steps, has the ids of letters and of the
# signs behind them one after another, in any case.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STEPS = {"NFC", "Lowercase", "Replace"}
LINE_WORDS = 64
_SPACES = re.compile(r"[ \t\n\r\x0b\x0c]+")
_ENCODERS: dict[str, WordEncoder] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Word codes of all texts, the distinct words, and where each text's words start."""
    codes, distinct, starts = _split(texts)
    return codes, _strings(distinct), starts


def _strings(words: pa.Array) -> list[str]:
    """As ``to_pylist``, in one call instead of one for each word."""
    return words.to_numpy(zero_copy_only=False).tolist()


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    words = pc.ascii_split_whitespace(filled)
    coded = words.flatten().dictionary_encode()
    starts = words.offsets.to_numpy() - words.offsets[0].as_py()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, coded.dictionary, starts.astype(np.int64)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts that start at ``bounds``, with ``end_id`` after each text."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Ids are below it, also if a vocabulary leaves some out.
        self.size = max(self._tokenizer.get_vocab().values()) + 1
        self.width = 2 if self.size <= 1 << 16 else 4
        self._pattern, self._closing = self._word_ends()
        self._folds = self._letters_apart()
        # A mark that is one token by itself parts words that are encoded together.
        alone = self._tokenizer.encode(MARK, add_special_tokens=False).ids
        self._mark = alone[0] if len(alone) == 1 else None
        self._slot: dict[str, int] = {}
        self._lengths = self._firsts = self._met = self._pool = np.zeros(0, dtype=np.int64)
        self._forget()

    def _word_ends(self) -> tuple[str | None, np.ndarray | None]:
        """Pattern of the parts of a word, and which ids end a part, where the file says so."""
        spec = json.loads(self._tokenizer.to_str())
        suffix = spec["model"].get("end_of_word_suffix")
        before = spec.get("pre_tokenizer") or {}
        first = (before.get("pretokenizers") or [before])[0]
        pattern = first.get("pattern", {}).get("Regex")
        if not suffix or not pattern or not first.get("invert") or first["behavior"] != "Removed":
            return None, None
        closing = np.zeros(self.size, dtype=bool)
        for token, i in self._tokenizer.get_vocab().items():
            closing[i] = token.endswith(suffix)
        return pattern, closing

    def _letters_apart(self) -> bool:
        """Whether letters and the signs behind them may be encoded apart, in lower case."""
        spec = json.loads(self._tokenizer.to_str())
        first = spec.get("normalizer") or {}
        steps = first.get("normalizers") or [first]
        white = [x["pattern"] == {"Regex": r"\s+"} for x in steps if x.get("type") == "Replace"]
        names = [x.get("type") for x in steps]
        # Added tokens are found before all steps; those of a sign and then a letter are in none.
        added = [re.search(r"[^\w\s]\w", x["content"]) for x in spec.get("added_tokens") or []]
        return (
            self._closing is not None
            and self._pattern == _PARTS
            and "Lowercase" in names
            and set(names) <= _STEPS
            and all(white)
            and all(added)
        )

    def _forget(self) -> None:
        """Drop the words that were met once only, or all if most were met again."""
        met = np.flatnonzero(self._met[: len(self._slot)]) if self._slot else []
        kept = len(met) <= MOST_WORDS // 2 and self._lengths[met].sum() <= MOST_IDS // 2
        words, old = list(self._slot) if kept else [], self._slot
        self._slot = {}
        lengths, firsts, pool = self._lengths, self._firsts, self._pool
        self._lengths = np.zeros(1024, dtype=np.int64)
        self._firsts = np.zeros(1024, dtype=np.int64)
        self._met = np.zeros(1024, dtype=bool)
        self._pool = np.zeros(4096, dtype=np.uint32)
        self._used = 0
        if kept and old:
            self._slot.update((words[i], n) for n, i in enumerate(met.tolist()))
            n = lengths[met]
            before = np.cumsum(n) - n
            self._add(n, pool[np.repeat(firsts[met] - before, n) + np.arange(n.sum())])

    def _add(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Append to the arrays, which double when they are full."""
        words = len(self._slot)
        at = words - len(lengths)
        while words > len(self._lengths):
            self._lengths = np.concatenate([self._lengths, np.zeros_like(self._lengths)])
            self._firsts = np.concatenate([self._firsts, np.zeros_like(self._firsts)])
            self._met = np.concatenate([self._met, np.zeros_like(self._met)])
        while self._used + len(ids) > len(self._pool):
            self._pool = np.concatenate([self._pool, np.zeros_like(self._pool)])
        self._lengths[at:words] = lengths
        self._firsts[at:words] = self._used + np.cumsum(lengths) - lengths
        self._pool[self._used : self._used + len(ids)] = ids
        self._used += len(ids)

    def _slots(self, distinct: list[str]) -> np.ndarray:
        if len(self._slot) > MOST_WORDS or self._used > MOST_IDS:
            self._forget()
        slot = self._slot
        met = map(slot.get, distinct, repeat(-1))
        found = np.fromiter(met, dtype=np.int64, count=len(distinct))
        self._met[found[found >= 0]] = True
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = list(dict.fromkeys(distinct[i] for i in missing))
            for start in range(0, len(new), ENCODE_WORDS):
                for words, (lengths, ids) in self._encoded(new[start : start + ENCODE_WORDS]):
                    slot.update(zip(words, range(len(slot), len(slot) + len(words)), strict=True))
                    self._add(lengths, ids)
            found[missing] = [slot[distinct[i]] for i in missing]
        return found

    def _encoded(self, words: list[str]) -> list[tuple[list[str], tuple[np.ndarray, np.ndarray]]]:
        """The words, in some order, with their lengths and ids."""
        if len(words) < LINE_WORDS:
            # Making the patterns ready costs more than a few words save.
            return [(words, self._apart(words))]
        if self._closing is not None:
            steady = pc.match_substring_regex(pa.array(words, pa.string()), _STEADY).to_pylist()
            plain = [w for w, good in zip(words, steady, strict=True) if good]
            odd = [w for w, good in zip(words, steady, strict=True) if not good]
            return [(plain, self._in_lines(plain)), (odd, self._apart(odd))]
        plain = [w for w in words if MARK not in w] if self._mark is not None else []
        odd = [w for w in words if MARK in w] if plain else words
        return [(plain, self._together(plain)), (odd, self._apart(odd))]

    def _in_lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of words that are encoded many to a line.

        A word has as many parts as the pattern finds in it, and the ids tell where a part
        ends. A line whose number of parts is not that of its words sends all to ``_apart``.
        """
        if not words:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)
        lower = pc.utf8_lower(pa.array(words, pa.string()))
        parts = pc.count_substring_regex(lower, self._pattern).to_numpy(zero_copy_only=False)
        starts = range(0, len(words), LINE_WORDS)
        lines = [" ".join(words[i : i + LINE_WORDS]) for i in starts]
        found = [
            np.array(e.ids, dtype=np.uint32)
            for e in self._tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ]
        counted = np.array([self._closing[ids].sum() for ids in found])
        if not parts.all() or (counted != np.add.reduceat(parts, list(starts))).any():
            return self._apart(words)
        ids = np.concatenate(found)
        last = np.flatnonzero(self._closing[ids])[np.cumsum(parts) - 1]
        return np.diff(np.concatenate([[-1], last])), ids

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of words, each encoded by itself."""
        found = [e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter((len(i) for i in found), dtype=np.int64, count=len(found))
        return lengths, np.array([i for w in found for i in w], dtype=np.uint32)

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words without the mark, many to a text with the mark between them."""
        if not words:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)
        lines = [f" {MARK} ".join([*words[i : i + 64], ""]) for i in range(0, len(words), 64)]
        found = self._tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in found])
        marks = np.flatnonzero(ids == self._mark)
        if len(marks) != len(words):
            return self._apart(words)
        return np.diff(np.concatenate([[-1], marks])) - 1, np.delete(ids, marks)

    def counts(self, distinct: list[str]) -> np.ndarray:
        """Number of ids of each word."""
        slots = self._slots(distinct)
        return self._lengths[slots]

    def count(self, text: str) -> int:
        """Number of ids of one text."""
        words = text.split(" ") if text.isascii() and text.isprintable() else _SPACES.split(text)
        words = [w for w in words if w]
        slots = self._slots(words)
        return int(self._lengths[slots].sum())

    def _stems(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths and first places of the ids of words, and the ids there.

        Letters with signs behind them are two parts, and letters are the same in any case:
        texts have far fewer different parts than words.
        """
        if not self._folds or not len(distinct):
            slots = self._slots(_strings(distinct))
            return self._lengths[slots], self._firsts[slots], self._pool
        letters = pc.utf8_rtrim(distinct, _SIGNS)
        plain = pc.match_substring_regex(letters, _LETTERS + "$")
        stems = pc.if_else(plain, pc.utf8_lower(letters), distinct).dictionary_encode()
        longer = pc.not_equal(pc.binary_length(letters), pc.binary_length(distinct))
        ends = np.flatnonzero(pc.and_(plain, longer).to_numpy(zero_copy_only=False))
        signs = pc.replace_substring_regex(distinct.take(pa.array(ends)), _LETTERS, "")
        signs = signs.dictionary_encode()
        # In one call, as the next may empty the cache.
        words = _strings(stems.dictionary)
        slots = self._slots(words + _strings(signs.dictionary))
        parts = np.zeros((len(distinct), 2), dtype=np.int64)
        parts[:, 0] = slots[stems.indices.to_numpy()]
        parts[ends, 1] = slots[len(words) :][signs.indices.to_numpy()]
        counts = np.zeros_like(parts)
        counts[:, 0] = self._lengths[parts[:, 0]]
        counts[ends, 1] = self._lengths[parts[ends, 1]]
        # The ids of a word's parts follow each other in ``flat``.
        counts = counts.ravel()
        before = np.cumsum(counts) - counts
        places = np.repeat(self._firsts[parts].ravel() - before, counts)
        flat = self._pool[places + np.arange(len(places))]
        return counts[::2] + counts[1::2], before[::2], flat

    def encode_words(
        self,
        codes: np.ndarray,
        distinct: list[str] | pa.Array,
        starts: np.ndarray,
        end_id: int | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids start (one more than texts)."""
        if isinstance(distinct, list):
            distinct = pa.array(distinct, pa.large_string())
        lengths, firsts, pool = self._stems(distinct)
        lengths = lengths[codes]
        before = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        ids = pool[np.repeat(firsts[codes] - before, lengths) + np.arange(total)]
        bounds = np.concatenate([before, [total]])[starts]
        return (ids, bounds) if end_id is None else with_end(ids, bounds, end_id)

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        return self.encode_words(*_split(texts), end_id)
