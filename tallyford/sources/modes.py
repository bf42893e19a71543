"""Save modes."""

# Accepted mode names and Spark's save modes.
SAVE_MODES = {
    "append": "append",
    "update": "append",
    "complete": "overwrite",
    "overwrite": "overwrite",
    "errorifexists": "errorifexists",
    "ignore": "ignore",
}


def save_mode(mode: str) -> str:
    try:
        return SAVE_MODES[mode.lower()]
    except KeyError:
        raise ValueError(f"invalid save mode {mode!r}") from None
