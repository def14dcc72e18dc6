"""Test oracles: the line rules of SURVEY §2.3 stated in plain Python.

They define expected values independently of Spark; the patterns are the
fixed values kept in ``logscan.functions.text``.
"""

import math
import re

import numpy as np

from logscan.functions.text import IP_PATTERN, IP_TOKEN, NULL_MESSAGE, TIME_SUFFIX, USER_PATTERN, USER_TOKEN

# Applied in this order: addresses first, then user ids.
_RULES = [(re.compile(IP_PATTERN), IP_TOKEN), (re.compile(USER_PATTERN), USER_TOKEN)]


def mask(message):
    """Spec F1/F2: a missing message is the text None; then every rule."""
    text = NULL_MESSAGE if message is None else str(message)
    for pattern, token in _RULES:
        text = pattern.sub(token, text)
    return text


def parse(raw):
    """Spec F3: at most one unit suffix removed, then Python's float();
    anything it rejects (or null) is 0.0; the result is stored as float32."""
    text = raw
    if isinstance(text, str) and text.endswith(TIME_SUFFIX):
        text = text[: len(text) - len(TIME_SUFFIX)]
    if not isinstance(text, str):
        return 0.0
    try:
        number = float(text)
    except ValueError:
        return 0.0
    with np.errstate(over="ignore"):
        return float(np.float32(number))


def text_of(v):
    """Spec F5: Python's text of a float32 value widened to double."""
    return str(float(np.float32(v)))


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or a == b
    return a == b
