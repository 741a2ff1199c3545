"""Staging of source files on the driver, with a cache keyed by URL."""

from __future__ import annotations

import hashlib
import shutil
import urllib.error
import urllib.parse
import urllib.request
from pathlib import Path

from quernstone.errors import FetchError
from quernstone.model import RunContext

TIMEOUT_S = 60


def cached_path(url: str, ctx: RunContext) -> Path:
    """The cache entry of a URL; its suffix is kept so that readers see the codec."""
    name = Path(urllib.parse.urlparse(url).path).name
    return ctx.cache_dir / hashlib.sha256(url.encode()).hexdigest() / (name or "content")


def fetch(url: str, ctx: RunContext) -> Path:
    """The local path of ``url``. A cache hit ends it, also for changed files; a miss fails when offline."""
    path = cached_path(url, ctx)
    if path.exists():
        return path
    if ctx.offline:
        raise FetchError(f"offline and not in the cache: {url}")
    parts = urllib.parse.urlparse(url)
    part = path.with_name(path.name + ".part")
    path.parent.mkdir(parents=True, exist_ok=True)
    try:
        if parts.scheme == "file":
            shutil.copyfile(urllib.request.url2pathname(parts.path), part)
        elif parts.scheme in ("http", "https"):
            with urllib.request.urlopen(url, timeout=TIMEOUT_S) as r, part.open("wb") as f:
                shutil.copyfileobj(r, f)
        else:
            raise FetchError(f"unsupported scheme: {url}")
    except (OSError, urllib.error.URLError) as e:
        raise FetchError(f"cannot fetch {url}: {e}") from e
    part.rename(path)
    return path
