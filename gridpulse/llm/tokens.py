"""Tokenizers inside tasks.

Texts are cut at spaces into chunks that a tokenizer treats each for itself, and a task tokenizes each of its chunks once, however often it
occurs.  Where a cut would not be safe, chunks stay together.  Tokenizer files are opened by path, once in each Python worker that Spark keeps
for later tasks; they must lie at the same place on all executors.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from string import ascii_lowercase, ascii_uppercase
from types import ModuleType
from typing import Any

import numpy as np

#: Distinct chunks, and characters of chunks, that a task remembers; when it has more, it forgets all that are not wanted next.
REMEMBERED, REMEMBERED_CHARS = 1 << 18, 1 << 24

#: Chunks that are handed to a tokenizer as one text; one text costs far less than many short ones.
JOINED = 1024

# A space after one of these is no safe cut: some engines count it as white space, and white space belongs to what follows.
_WHITE = r"[\s\x00-\x20\x7f-\xa0" + "\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
# The space is looked for first: a pattern that begins with a class and has branches is tried at every character.
_UNSAFE, _UNSAFE_END = re.compile(f" (?<={_WHITE} )"), re.compile(_WHITE)


def public_path(name: str) -> str:
    """Where a file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def kept(kind: str, path: str, make: Callable[[str], Any]) -> Any:
    """What `make` reads from a file, read once per Python process.

    Functions travel by value, so their own module is a new one in each task; what is kept must be plain data or of a library.
    """
    of_process = vars(sys.modules.setdefault("_gridpulse_kept", ModuleType("_gridpulse_kept")))
    key = f"{kind} {path} {os.stat(path).st_mtime_ns}"
    if key not in of_process:
        of_process[key] = make(path)
    return of_process[key]


def tokenizer(path: str, plain_specials: bool):
    """A tokenizer of the `tokenizers` library; `plain_specials`: special tokens' strings inside texts are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = plain_specials
    return made


def chunks(text: str) -> list[str]:
    """Pieces that, each with a space in front, make up `" " + text`, cut only where the character before the space is not white."""
    pieces = text.split(" ")
    if pieces[0] and pieces[-1] and not _UNSAFE.search(text):
        return pieces
    out: list[str] = []
    held: list[str] = []
    for piece in pieces:
        held.append(piece)
        if safe_end(piece):
            out.append(" ".join(held))
            held = []
    if held == [""] and out:
        out[-1] += " "  # nothing may follow the last space: no tokenizer sees a space in front of nothing
    elif held:
        out.append(" ".join(held))
    return out


def safe_ends(some: list[str]) -> bool:
    """Whether these chunks may follow each other in any order."""
    return "" not in some and not _UNSAFE.search(" ".join([*some, ""])) or all(map(safe_end, some))


def safe_end(chunk: str) -> bool:
    """Whether any other chunk may follow this one."""
    return bool(chunk) and not _UNSAFE_END.match(chunk, len(chunk) - 1)


class Remembered:
    """What `make` gives for chunks, as pairs, made once for each distinct one; `make` takes up to `at_once` of them."""

    def __init__(self, make: Callable[[list[str]], Iterable[tuple[str, object]]], at_once: int, most: int = REMEMBERED) -> None:
        self.make, self.at_once, self.most, self.known, self.chars = make, at_once, most, {}, 0

    def of(self, wanted: set[str]) -> dict[str, object]:
        """A table that has at least the wanted chunks."""
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > self.most or self.chars > REMEMBERED_CHARS:
            self.known = {c: self.known[c] for c in wanted if c in self.known}
            self.chars = sum(map(len, self.known))
        for k in range(0, len(new), self.at_once):
            self.known.update(self.make(new[k : k + self.at_once]))
        self.chars += sum(map(len, new))
        return self.known


_LETTERS = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u048a-\u04ff"
# The stop is looked for first: a pattern that begins with a look behind is tried at every character.
_WORD, _STOP = re.compile(f"[{_LETTERS}]+"), re.compile(f"([.,])(?<=[{_LETTERS}0-9][.,]) ")
_WORD_END = "</w>"


# A word and what may stand behind it, all of it one token piece of its own to such a tokenizer.
_STOPS = "!#$%&*+,./:;=?@^_~)-"
_ENDED = re.compile(f"([{_LETTERS}]+)([{_STOPS}]{{1,3}})")


def _word_tokenizer(path: str) -> tuple[Any, np.ndarray, bool]:
    """A tokenizer, which ids end a word, and whether it reads ASCII letters of either case alike and parts words from what `_ENDED` finds."""
    made = tokenizer(path, plain_specials=False)
    ids = lambda text: made.encode(text, add_special_tokens=False).ids
    parts = ids(ascii_uppercase) == ids(ascii_lowercase) and all(ids(f"ab{p}") == ids("ab") + ids(p) for p in _STOPS)
    return made, np.array([(made.id_to_token(k) or "").endswith(_WORD_END) for k in range(made.get_vocab_size())]), parts


def ids_of_words(path: str) -> Callable[[list[str]], list[bytes]]:
    """Token ids of texts, as little-endian unsigned 32-bit numbers, by a tokenizer that drops white space and marks the ends of words.

    Such a tokenizer never joins a word and the stop behind it.
    """
    (made, ends_word, alike), whole, ended = kept("word ids", path, _word_tokenizer), _WORD.fullmatch, _ENDED.fullmatch

    def separately(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in made.encode_batch_fast(texts, add_special_tokens=False)]

    def jointly(words: list[str]) -> Iterable[bytes]:
        """Words of letters only have one word end each."""
        ids = np.array(made.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ends_word[ids]) + 1
        raw, at = ids.tobytes(), (4 * ends).tolist()
        return map(raw.__getitem__, map(slice, [0, *at], at)) if len(ends) == len(words) else separately(words)

    def encode(some: list[str]) -> Iterator[tuple[str, bytes]]:
        words, others, made_of = [], [], []
        for c in some:
            if whole(c):
                words.append(c)
            elif alike and (parts := ended(c)):
                made_of.append((c, *parts.groups()))
            else:
                others.append(c)
        plain = {w: w.lower() if alike and w.isascii() else w for w in (*words, *(word for _, word, _ in made_of))}
        tails = list({tail for _, _, tail in made_of}.difference(of_tail))
        of_tail.update(zip(tails, separately(tails)))
        new = list(set(plain.values()).difference(remembered.known))
        found = dict(zip(new, jointly(new))) if new else {}
        of = {w: found[p] if p in found else remembered.known[p] for w, p in plain.items()}
        yield from found.items()
        yield from ((w, of[w]) for w in words)
        yield from ((c, of[word] + of_tail[tail]) for c, word, tail in made_of)
        if others:
            yield from zip(others, separately(others))

    of_tail: dict[str, bytes] = {}
    remembered = Remembered(encode, JOINED, 2 * REMEMBERED)  # ids take little room

    def ids(texts: list[str]) -> list[bytes]:
        cut = [_STOP.sub(r" \1 ", t.replace("\n", " ")).split(" ") for t in texts]
        known = remembered.of(set().union(*cut)).__getitem__
        return [b"".join(map(known, pieces)) for pieces in cut]

    return ids
