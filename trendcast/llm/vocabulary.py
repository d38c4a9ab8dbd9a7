"""Encoding with the public tokenizer files, through caches of what texts repeat.

Words repeat, so texts are cut where no token can reach across, and each distinct cut is encoded once per worker.
The caches are emptied when they reach ``CACHE`` bytes, so memory stays bounded.
"""

from __future__ import annotations

import os
import re
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE, ENTRY = 48 << 20, 200  # bytes of a cache, and of an entry beside what it holds
# White space as the tokenizers' patterns have it, which is not quite Python's.
SPACE = "\t\n\v\f\r \x85\xa0  -     　"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class ByteLetters(dict):
    """Bytes of a text, as a str.translate table over latin-1."""

    def __init__(self):
        super().__init__({b: letter for b, letter in enumerate(byte_letters())})

    def spell(self, text: str) -> str:
        return text if text.isascii() and text.isalpha() else text.encode().decode("latin-1").translate(self)


# Letters and other characters of those texts whose pieces plain patterns find: ASCII and accented Latin-1 letters.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
PLAIN = re.compile(f"[\n\x20-\x7e{LETTERS}]*")


class Encoder:
    """A tokenizer with a cache of what its pieces give."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.model, self.letters = self.tokenizer.model, ByteLetters()
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.known: dict[str, bytes] = {}
        self.held = 0

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.specials)

    def fresh(self, piece: str) -> bytes:
        raise NotImplementedError

    def all_of(self, pieces: list[str]) -> bytes:
        """What the pieces of one text give, in order."""
        known = self.known
        missing = set(pieces).difference(known)
        if self.held > CACHE:
            known.clear()
            self.held, missing = 0, set(pieces)
        for piece in missing:
            found = known[piece] = self.fresh(piece)
            self.held += len(piece) + len(found) + ENTRY
        return b"".join(map(known.__getitem__, pieces))


class WordEncoder(Encoder):
    """Ids by a vocabulary that drops white space, lower-cases and ends words: little-endian unsigned 32-bit bytes."""

    # Fixed value: the public vocabulary's pattern, for lower-cased plain texts.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\x20\na-z\xdf-\xf6\xf8-\xff0-9]+")

    def fresh(self, piece: str) -> bytes:
        """``piece`` is a piece of a plain text, or any text after a line break."""
        if piece[0] == "\n":
            ids = self.tokenizer.encode(piece[1:], add_special_tokens=False).ids
        else:
            ids = [t.id for t in self.model.tokenize(self.letters.spell(piece))]
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and not self.has_special(text):
            return self.all_of(self.PIECES.findall(text.lower()))
        return self.all_of(["\n" + chunk for chunk in text.replace("\n", " ").split(" ") if chunk])


class PrefixCounter(Encoder):
    """Token counts of every prefix of a text, by a byte-level vocabulary.

    Within a piece, the tokens of each prefix end in the one token whose pair with the last token before it stays a
    pair when both are encoded together; that gives all prefixes of a piece in one pass. Pieces follow from the
    text's own classes of characters, so counts of a prefix of the text are those of its whole pieces and of the
    last one's prefix. A run of white space counts as one piece as long as nothing follows.
    """

    # Fixed value: the public vocabulary's pattern, for plain texts.
    PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^ \n{LETTERS}0-9]+|[ \n]+(?![^ \n])|[ \n]+")

    def __init__(self, path: str):
        import regex

        super().__init__(path)
        # Fixed value: the same pattern for all texts.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.runs = re.compile(f"[{SPACE}]{{2,}}(?=[^{SPACE}])")
        self.vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.longest = max(map(len, self.vocab))
        self.pairs: dict[str, bool] = {}

    def stays(self, left: str, right: str) -> bool:
        key = f"{left} {right}"  # a space is no letter of a spelled token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE // ENTRY:
                self.pairs.clear()
            known = [t.value for t in self.model.tokenize(left + right)] == key.split()
            self.pairs[key] = known
        return known

    def prefixes(self, piece: str) -> list[int]:
        """Counts after each character of a piece, 0 first."""
        spelled = self.letters.spell(piece)
        vocab, stays, longest = self.vocab, self.stays, self.longest
        counts, last, begin = [0], [""], 0
        for end in range(1, len(spelled) + 1):
            token = spelled[begin:end]  # most often the last token has grown
            if token not in vocab or not stays(last[begin], token):
                for begin in range(end - 1, max(-1, end - longest - 1), -1):
                    token = spelled[begin:end]
                    if token in vocab and stays(last[begin], token):
                        break
            counts.append(counts[begin] + 1)
            last.append(token)
        if len(spelled) > len(piece):
            ends, at = [0], 0
            for c in piece:
                at += len(c.encode())
                ends.append(counts[at])
            return ends
        if len(piece) == 3 and piece in ("'re", "'ve", "'ll"):  # until its last letter comes, a mark and a letter
            counts[2] = 2
        return counts

    def fresh(self, piece: str) -> bytes:
        counts = self.prefixes(piece)
        return array("h", map(int.__sub__, counts[1:], counts)).tobytes()

    def _ordinary(self, text: str) -> bytes:
        pattern = self.PIECES if PLAIN.fullmatch(text) else self.pattern
        changes = self.all_of(pattern.findall(text))
        runs = list(self.runs.finditer(text))
        if not runs:
            return changes
        changes = array("h", changes)
        for run in runs:  # before the next character comes, the last of the run belongs to it
            counts = self.prefixes(run[0])
            end = run.end()
            moved = changes[end - 1] - (counts[-1] - counts[-2])
            changes[end - 1] -= moved
            changes[end] += moved
        return changes.tobytes()

    def changes(self, text: str) -> bytes:
        """Changes of the token count after each character, as 16-bit numbers. Special strings count as one token."""
        if not self.has_special(text):
            return self._ordinary(text)
        cut, out, at = re.compile("|".join(map(re.escape, self.specials))), [], 0
        for m in cut.finditer(text):
            part = array("h", self._ordinary(text[at:m.end()]))
            before = sum(array("h", self._ordinary(text[at:m.start()])))
            part[-1] = before + 1 - sum(part[:-1])
            out.append(part.tobytes())
            at = m.end()
        return b"".join(out) + self._ordinary(text[at:])
