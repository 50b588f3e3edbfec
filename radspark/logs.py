"""Logging of the engine, set up by one ``logging.config`` dictionary.

A line is one JSON object: ``at`` (seconds since 1970), ``level``, ``event``
(the message), ``source`` (service and logger), ``fields`` (everything the
caller passed as ``extra``) and, after an exception, ``error``. For people
there are console lines instead, coloured on a terminal.
"""

from __future__ import annotations

import json
import logging
import logging.config
import sys

#: What every record has; anything else on it came from the caller.
_PLAIN = set(vars(logging.makeLogRecord({}))) | {"message", "asctime", "taskName"}
COLOURS = {"DEBUG": 36, "INFO": 32, "WARNING": 33, "ERROR": 31, "CRITICAL": 35}


def fields_of(record: logging.LogRecord) -> dict:
    return {k: v for k, v in vars(record).items() if k not in _PLAIN}


class AsJson(logging.Formatter):
    def __init__(self, service: str = "radspark"):
        super().__init__()
        self.service = service

    def format(self, record: logging.LogRecord) -> str:
        line = {"at": round(record.created, 3), "level": record.levelname.lower(), "event": record.getMessage(), "source": f"{self.service}/{record.name}", "fields": fields_of(record)}
        if record.exc_info:
            line["error"] = self.formatException(record.exc_info).splitlines()[-1]
        return json.dumps(line, default=str, sort_keys=True)


class ForPeople(logging.Formatter):
    def __init__(self, colour: bool | None = None):
        super().__init__("{asctime} {levelname:<8} {name} | {message}", style="{", datefmt="%H:%M:%S")
        self.colour = sys.stderr.isatty() if colour is None else colour

    def format(self, record: logging.LogRecord) -> str:
        text = super().format(record) + "".join(f" {k}={v}" for k, v in fields_of(record).items())
        return f"\x1b[{COLOURS.get(record.levelname, 0)}m{text}\x1b[0m" if self.colour else text


def setup(level: str = "INFO", as_json: bool = True, path: str | None = None, service: str = "radspark", colour: bool | None = None) -> logging.Logger:
    """The logger of ``service``: lines to standard error, and JSON lines to ``path`` where one is given."""
    handlers = {"stderr": {"class": "logging.StreamHandler", "formatter": "json" if as_json else "people"}}
    if path:
        handlers["file"] = {"class": "logging.FileHandler", "filename": path, "formatter": "json"}
    logging.config.dictConfig({
        "version": 1, "disable_existing_loggers": False, "handlers": handlers,
        "formatters": {"json": {"()": AsJson, "service": service}, "people": {"()": ForPeople, "colour": colour}},
        "loggers": {service: {"level": level, "handlers": list(handlers)}}})
    return logging.getLogger(service)
