"""Reaching definitions of one variable, as pairs that go out as they are found."""


class _Either:
    """What two ways lead to, without copying either."""

    __slots__ = ("one", "other")

    def __init__(self, one, other):
        self.one, self.other = one, other


def _united(one, other):
    if one is other or other is None:
        return one
    return other if one is None else _Either(one, other)


def _found(reach, before=None):
    """Definitions (strings) and loop entries (numbers) of a reach, each once, but for what is reached by `before` only."""
    todo, seen, told = [reach], set(), set()
    while todo:
        part = todo.pop()
        if part is None or part is before:
            continue
        if isinstance(part, _Either):
            if id(part) not in seen:
                seen.add(id(part))
                todo += (part.other, part.one)
        elif isinstance(part, tuple):  # what the body of a loop has added
            todo += part
        elif part not in told:
            told.add(part)
            yield part


def reaching_pairs(events):
    """(definition, use) pairs of one run of (kind, node, frames), each once and as soon as it is known.

    frames are (statement, arm), outermost first. A reach shares its parts with those before it, so a definition is
    held once however many uses it reaches, and no pair is held. A loop keeps the uses that its entry reaches until it
    ends: only then is known what its body leads back to them.
    """
    reach = None
    open_frames = []  # [statement, arm, reach on entry, reach after the other arm, uses that saw the entry]
    loops = {}  # frames of the open loops by statement

    def close():
        nonlocal reach
        statement, arm, entry, other, looked = open_frames.pop()
        if arm != "loop":
            reach = _united(reach, other)
            return
        del loops[statement]
        made = tuple(d for d in _found(reach, entry) if isinstance(d, str))
        if made:
            for look in looked:
                use, reaches = look
                known = {d for part in reaches for d in _found(part, entry)}
                yield from ((definition, use) for definition in made if definition not in known)
                reaches.append(made)  # an outer loop leads back no pair twice
        reach = _united(entry, made or None)

    for kind, node, frames in events:
        shared = 0
        while shared < min(len(frames), len(open_frames)) and open_frames[shared][:2] == list(frames[shared]):
            shared += 1
        turns = shared < min(len(frames), len(open_frames)) and open_frames[shared][0] == frames[shared][0]
        while len(open_frames) > shared + turns:
            yield from close()
        if turns:  # from the first arm of an `if` to its second
            frame = open_frames[shared]
            frame[1], frame[3], reach = frames[shared][1], reach, frame[2]
            shared += 1
        for statement, arm in frames[shared:]:
            open_frames.append([statement, arm, reach, reach, []])
            if arm == "loop":
                loops[statement] = open_frames[-1]
                reach = _united(reach, statement)
        if kind == "def":
            reach = node
            continue
        look = None
        for found in _found(reach):
            if isinstance(found, str):
                yield found, node
            else:
                look = look or (node, [reach])
                loops[found][4].append(look)
    while open_frames:
        yield from close()
