"""Driver-side logging: a line's extra values follow it as sorted name=value pairs."""

from __future__ import annotations

import logging
import time
from logging.handlers import RotatingFileHandler
from pathlib import Path

_USUAL = frozenset(logging.makeLogRecord({}).__dict__) | {"message", "asctime", "taskName"}


class PairFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        line, rest = super().format(record), sorted((k, v) for k, v in record.__dict__.items() if k not in _USUAL)
        head, newline, trace = line.partition("\n")
        pairs = " ".join(f"{k}={v}" for k, v in rest)
        return (f"{head} | {pairs}" if pairs else head) + newline + trace


def set_up(level: str = "INFO", folder: str | None = None, name: str = "folioweave", max_bytes: int = 5_242_880, backups: int = 5) -> logging.Logger:
    """The engine's logger: to the console and, with a folder, to a file of its own for this run. A second call replaces the first's handlers."""
    log = logging.getLogger(name)
    log.setLevel(level)
    for h in list(log.handlers):
        log.removeHandler(h)
        h.close()
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if folder:
        Path(folder).mkdir(parents=True, exist_ok=True)
        handlers.append(RotatingFileHandler(Path(folder) / f"{name}_{time.strftime('%Y%m%d_%H%M%S')}.log", maxBytes=max_bytes, backupCount=backups, encoding="utf-8"))
    for h in handlers:
        h.setFormatter(PairFormatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
        log.addHandler(h)
    log.propagate = False
    return log
