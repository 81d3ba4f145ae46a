"""Public byte-level vocabularies, read on the driver and sent to the tasks (under 1 MB)."""

from __future__ import annotations

import base64
import functools
from pathlib import Path

VOCABULARIES = "/opt/tokenizers"
PLAIN, MULTI = "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"
#: The first id that neither vocabulary uses.
FREE = 50256


def ranks_file(folder: str = VOCABULARIES, name: str = PLAIN) -> bytes:
    return Path(folder, name).read_bytes()


def first_free(raw: bytes) -> int:
    """The first id that a file of ranks doesn't use."""
    return max((int(line.split()[1]) for line in raw.splitlines() if line.strip()), default=-1) + 1


@functools.lru_cache(2)
def _built(raw: bytes):
    import tiktoken
    from public_tokenizers import PATTERN

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, raw.splitlines()))}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoder(raw: bytes):
    """The encoding of a file of ranks; built once in each Python worker."""
    return _built(raw)
