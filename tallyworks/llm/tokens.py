"""Token ids of texts by a public byte-level vocabulary.

The ids are those of the ``tokenizers`` file. The same vocabulary exists as ranks for a faster
library; texts made of plain Latin characters, for which both split alike, go that way, all others
(unusual spaces, other scripts, the text of a special token) through the file itself. A test holds
the two against each other.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache


# Any character outside of these sends a text to the slower way.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")
SPECIAL = "<|"


@lru_cache(maxsize=2)
def _file(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _ranks(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Vocabulary:
    """Paths of a vocabulary; the models are loaded where they are used."""

    def __init__(self, file: str, ranks: str | None = None, pattern: str | None = None) -> None:
        self.file, self.ranks, self.pattern = file, ranks, pattern

    def encode(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of each text, without special tokens; a null text has none."""
        for text in texts:
            if not text:
                yield []
            elif self.ranks is None or SPECIAL in text or UNUSUAL.search(text):
                yield _file(self.file).encode(text, add_special_tokens=False).ids
            else:
                yield _ranks(self.ranks, self.pattern).encode_ordinary(text)


def public(name: str = "byte_bpe_50k") -> Vocabulary:
    """The vocabulary of that name among the installed public ones."""
    import public_tokenizers

    return Vocabulary(
        public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN
    )


