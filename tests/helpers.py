"""Pure-Python twins of the tags, for brute-force checks on small fixtures."""

import hashlib


def part(value) -> str:
    """Identity text of one value."""
    return "-" if value is None else f"{len(str(value))}#{value}"


def md5_hex(seed, *ids) -> str:
    """Priority of a row."""
    return hashlib.md5(":".join([str(seed), *map(part, ids)]).encode()).hexdigest()


def draw(seed, purpose, *parts, bound):
    h = hashlib.md5(":".join(str(p) for p in (seed, purpose, *parts)).encode()).hexdigest()
    return int(h[:15], 16) % bound


def pair_state_machine(seq):
    """seq: list of (is_left, id).  Returns list of (left_id, right_id)."""
    held = None
    out = []
    for is_left, ident in seq:
        if held is not None and held[0] != is_left:
            out.append((ident, held[1]) if is_left else (held[1], ident))
            held = None
        else:
            held = (is_left, ident)
    return out


def reservoir(seq_ids, k, seed, key_text=None, salt=""):
    """Slot-replacement reservoir with the same draws as kpool."""
    slots = {}
    for n, ident in enumerate(seq_ids, start=1):
        if n <= k:
            s = n
        else:
            parts = [salt] + ([part(key_text)] if key_text is not None else []) + [n]
            s = 1 + draw(seed, "slot", *parts, bound=n)
        if s <= k:
            slots[s] = (n, ident)
    return slots
