"""Where vocabulary files are."""

from __future__ import annotations

import os


def vocabulary_file(name: str) -> str:
    """A path as it is, a bare name as the file of the installed public vocabularies.

    Called where the file is read, so that each machine finds its own copy.
    """
    if os.path.dirname(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
