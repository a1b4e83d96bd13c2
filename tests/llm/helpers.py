WORD = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    """Lower-case A-Z only."""
    return (text or "").translate({c: c + 32 for c in range(65, 91)})
