"""Run configurations: samples and their options, with defaults, and what a run needs of its machine."""

from __future__ import annotations

import importlib.util
import sys
from collections.abc import Callable
from functools import wraps

DEFAULTS = "defaults"


def runs(documents: list[dict | None]) -> list[dict]:
    """The options of each sample from a configuration's documents: the one whose only key is ``defaults`` holds what a sample
    doesn't set itself. An option without a value is a flag. An option ``yaml`` is refused."""
    documents = [x for x in documents if x is not None]
    base: dict = {}
    for x in documents:
        if DEFAULTS in x:
            if len(x) != 1:
                raise ValueError(f"'{DEFAULTS}' must be the only key of its document")
            base = x[DEFAULTS] or {}
    out = [base | x for x in documents if DEFAULTS not in x]
    if any("yaml" in x for x in out):
        raise ValueError("a configuration can't name another one")
    return out


def load_runs(path: str) -> list[dict]:
    """``runs`` of a YAML file of one or more documents; needs the yaml package."""
    import yaml

    with open(path) as f:
        return runs(list(yaml.safe_load_all(f)))


def arguments(options: dict) -> list[str]:
    """Options as a command line's arguments."""
    return [x for k, v in options.items() for x in ([f"--{k}"] if v is None else [f"--{k}", str(v)])]


def requires(*packages: str, otherwise: Callable | None = None):
    """A decorator: the function runs only if all packages can be imported; else ``otherwise`` does, or an error says what is missing."""

    def wrap(fn):
        @wraps(fn)
        def run(*args, **kwargs):
            missing = [p for p in packages if importlib.util.find_spec(p) is None]
            if not missing:
                return fn(*args, **kwargs)
            if otherwise is None:
                raise ImportError(f"{fn.__name__} needs {', '.join(missing)}")
            return otherwise(*args, **kwargs)

        return run

    return wrap


def disabled_on(*systems: str):
    """A decorator: the function does nothing on the named systems (as in ``sys.platform``)."""
    return lambda fn: wraps(fn)(lambda *a, **k: None if sys.platform.startswith(systems) else fn(*a, **k))
