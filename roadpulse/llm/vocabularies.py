"""Where the public vocabulary files are."""

from __future__ import annotations

import os

#: Read from here unless the environment names another folder.
FOLDER = "/opt/tokenizers"


def byte_bpe() -> str:
    return os.path.join(os.environ.get("TOKENIZERS_DIR", FOLDER), "byte_bpe_50k.json")
