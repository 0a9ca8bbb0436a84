"""The two-slot state machine, message by message."""


def fold_pairs(rows):
    """[(emitting seq, news_seq, prices_seq)] of (seq, kind, empty) in order."""
    slots = {"news": None, "prices": None}
    out = []
    for s, k, e in rows:
        slots[k] = None if e else s
        if None not in slots.values():
            out.append((s, slots["news"], slots["prices"]))
            slots = dict.fromkeys(slots)
    return out
