"""Executor-side HTTP: transports, the retry loop and a per-task rate limiter.

This is the only Python that runs per request; it is I/O bound, so the
per-row cost is the network, not the interpreter.

Transports (picklable config dicts, built on the executor):
  ``{"kind": "file", "root": <dir>}``  canned responses, one JSON file per
      request at ``<root>/<first two digits>/<sha1(url)>.json`` (as ``write_store`` deals them, so that
      tasks do not wait for one folder) or right below the root: ``{"status", "retry_after", "body"}``
      or ``{"responses": [...]}`` with one such object per attempt (the last
      one repeats). A file that is absent from an existing folder is a 404; any
      other storage fault is "no response". Written by ``write_store`` (tests, replays).
  ``{"kind": "http", "base_url": ..., "token": ..., "timeout_s": ...}``
      real GETs with the auth header; cannot be exercised in this container.

Retry loop (``retry.py`` documents the same rules as column expressions):
  page policy    429 waits Retry-After (default 5 s) and asks again, without
                 bound unless ``max_429`` is given;
                 >= 500 / no response retried up to 3 tries with capped, jittered backoff;
                 other 4xx fail at once.
  entity policy  429 -> one retry after Retry-After (default 60 s); else fail.
Every attempt, retries included, goes through the task's rate limiter and is
counted in ``attempts``. A body that cannot be read or decoded is "no response".
"""

from __future__ import annotations

import hashlib
import http.client
import json
import random
import re
import threading
import time
import urllib.error
import urllib.request

from feedlake.operators import retry as rp


def request_key(url: str) -> str:
    return hashlib.sha1(url.encode("utf-8")).hexdigest()


def stored_at(url: str) -> str:
    """Path of a URL's response below the root of a store."""
    key = request_key(url)
    return f"{key[:2]}/{key}.json"


class Limiter:
    """At most ``limit`` calls in any trailing ``window_s``: call i goes at max(now, time of call i - limit + window).

    ``not_before`` (clock time) holds back the first call, e.g. until calls of an earlier phase have left the window.
    """

    def __init__(self, limit: int | None, window_s: float = 60.0, sleep=time.sleep, clock=time.time,
                 not_before: float | None = None):
        if limit is not None and limit < 1:
            raise ValueError("limit must be >= 1")
        self.window, self.sleep, self.clock = window_s, sleep, clock
        floor = float("-inf") if not_before is None else not_before - window_s
        self.admitted = None if limit is None else [floor] * limit
        self.n = 0
        self.lock = threading.Lock()

    def acquire(self) -> None:
        if self.admitted is None:
            return
        with self.lock:  # calls of one task leave in turn
            self._acquire()

    def _acquire(self) -> None:
        slot = self.n % len(self.admitted)
        now, due = self.clock(), self.admitted[slot] + self.window
        if due > now:
            self.sleep(due - now)
        self.admitted[slot] = max(now, due)
        self.n += 1


def open_fs(root: str):
    """(filesystem, base path) for a plain path, a ``file:`` URI or any URI pyarrow knows (hdfs, s3, ...)."""
    import pyarrow.fs as pafs

    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root[len("file:"):].lstrip("/")
    if "://" in root:
        return pafs.FileSystem.from_uri(root)
    return pafs.LocalFileSystem(), root


def _file_get(conf: dict, url: str, attempt: int):
    import pyarrow.fs as pafs

    try:
        fs, base = open_fs(conf["root"])
        for at in (stored_at(url), f"{request_key(url)}.json"):
            try:
                with fs.open_input_stream(f"{base.rstrip('/')}/{at}") as f:
                    doc = json.loads(f.read().decode("utf-8"))
                break
            except FileNotFoundError:
                continue
        else:
            if fs.get_file_info(base).type != pafs.FileType.Directory:
                return None, None, f"no response store at {conf['root']}"
            return 404, None, json.dumps({"message": "not found"})
    except (OSError, ValueError) as e:
        return None, None, f"unreadable response: {e}"
    if "responses" in doc:
        doc = doc["responses"][min(attempt, len(doc["responses"])) - 1]
    return int(doc.get("status", 200)), doc.get("retry_after"), doc.get("body")


def _http_get(conf: dict, url: str):
    req = urllib.request.Request(conf["base_url"].rstrip("/") + url)
    if conf.get("token"):
        req.add_header("X-Auth-Token", conf["token"])
    try:
        with urllib.request.urlopen(req, timeout=float(conf.get("timeout_s", 30))) as r:
            return r.status, r.headers.get("Retry-After"), r.read().decode("utf-8")
    except urllib.error.HTTPError as e:
        try:
            body = e.read().decode("utf-8", "replace")
        except (http.client.HTTPException, OSError):
            body = None
        return e.code, e.headers.get("Retry-After"), body
    except (urllib.error.URLError, http.client.HTTPException, OSError, UnicodeDecodeError) as e:
        return None, None, str(e) or type(e).__name__


def get(conf: dict, url: str, attempt: int = 1):
    """(status or None for no response, Retry-After, body or fault text)."""
    kind = conf.get("kind")
    if kind == "file":
        return _file_get(conf, url, attempt)
    if kind == "http":
        return _http_get(conf, url)
    raise ValueError(f"unknown transport {kind!r}")


def _after(header, default: int) -> int:
    """Whole seconds in ASCII digits, else the default."""
    text = "" if header is None else str(header).strip()
    return int(text) if re.fullmatch("[0-9]+", text) else default


def fetch(conf: dict, url: str, limiter: Limiter, policy: str = "page", max_429: int | None = None,
          sleep=time.sleep, jitter=random.SystemRandom().random) -> dict:
    """One request with the retry loop -> landing fields.

    ``jitter`` gives 0 to 1 s more for each wait after a fault. It draws from the system: workers
    forked from one process would draw the same numbers from a seeded generator.
    """
    if policy not in ("page", "entity"):
        raise ValueError(f"unknown retry policy {policy!r}")
    attempts, failures, throttled = 0, 0, 0
    while True:
        attempts += 1
        limiter.acquire()
        status, retry_after, body = get(conf, url, attempts)
        if status is not None and 200 <= status < 300:
            return dict(http_status=status, status="ok", attempts=attempts, error=None, payload=body)
        if status == 429:
            throttled += 1
            if policy == "entity" and attempts == 1:
                sleep(_after(retry_after, rp.ENTITY_429_DEFAULT_S))
                continue
            if policy == "page" and (max_429 is None or throttled <= max_429):
                sleep(_after(retry_after, rp.PAGE_429_DEFAULT_S))
                continue
        elif policy == "page" and (status is None or status >= 500):
            failures += 1
            if failures < rp.PAGE_ATTEMPTS:
                sleep(min(rp.PAGE_INITIAL_S * 2 ** (failures - 1) + jitter(), rp.PAGE_MAX_WAIT_S))
                continue
        try:
            msg = json.loads(body).get("message") if body else None
        except (ValueError, AttributeError):
            msg = None
        err = f"HTTP {status}: {msg or body}" if status is not None else f"Request failed: {body}"
        return dict(http_status=status, status="failed", attempts=attempts, error=err, payload=None)


def may_drop(got: dict) -> bool:
    """Failed requests that ``on_error='drop'`` may leave out: never those that were only throttled."""
    return got["status"] != "ok" and got["http_status"] != 429
