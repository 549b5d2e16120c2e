"""Token ids of texts under a public byte-level BPE tokenizer (inside tasks).

``path`` names the tokenizer file; its ids are the result.  ``ranks`` may name
the same vocabulary in rank form, from which the same ids come about four times
faster.  Texts that hold the opening of a special token go to the tokenizer
itself.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa

from dichot.llm.text import SPACE

# fixed value: the vocabulary's pattern without its look-ahead, which only
# matters where two white-space characters meet
_SINGLE_SPACES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
#: first bytes of the white space beyond ASCII, and \x1c-\x1f
_MAY_BE_SPACE = np.zeros(256, dtype=bool)
_MAY_BE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F]] = True


def _plain_spaces(texts: pa.Array) -> np.ndarray:
    """Texts whose white space is single ASCII characters."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    if data is None or at[-1] == at[0]:
        return np.ones(n, dtype=bool)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]]
    space = SPACE[raw]
    odd = _MAY_BE_SPACE[raw]
    odd[1:] |= space[1:] & space[:-1]
    out = np.ones(n, dtype=bool)
    out[np.searchsorted(at - at[0], np.flatnonzero(odd), side="right") - 1] = False
    return out


class TokenIds:
    def __init__(self, path: str, ranks: str | None = None) -> None:
        self.path = path
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast, self.full = (tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=table, special_tokens={}).encode_ordinary
                                    for p in (_SINGLE_SPACES, public_tokenizers.PATTERN))

    @cached_property
    def tokenizer(self):
        """The tokenizer itself, read when a text first needs it: with ranks few do,
        and a worker that lives on keeps its memory."""
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; none for a null or empty one."""
        plain = _plain_spaces(texts)
        out = []
        for text, simple in zip(texts.to_pylist(), plain.tolist()):
            if not text:
                found = []
            elif self.fast is None or "<|" in text:
                found = self.tokenizer.encode(text, add_special_tokens=False).ids
            else:
                found = self.fast(text) if simple else self.full(text)
            out.append(np.array(found, dtype="<u4"))
        return out


_kept: dict[tuple[str, str | None], TokenIds] = {}


def token_ids(path: str, ranks: str | None = None) -> TokenIds:
    """The worker's instance for a tokenizer file."""
    if (path, ranks) not in _kept:
        _kept[path, ranks] = TokenIds(path, ranks)
    return _kept[path, ranks]
