"""Record-by-record restatement of the unit rules, for tests only."""


def walk_key(rows, size, idle=None, deadline=None):
    """rows: (us, id) pairs of one key. Yields lists of rows, one per unit, in order."""
    open_unit = []
    for row in sorted(rows):
        if open_unit and (
            (idle is not None and row[0] - open_unit[-1][0] >= idle)
            or (deadline is not None and row[0] >= open_unit[0][0] + deadline)
        ):
            yield open_unit
            open_unit = []
        open_unit.append(row)
        if len(open_unit) == size:
            yield open_unit
            open_unit = []
    if open_unit:
        yield open_unit


def units(events, size, idle=None, deadline=None):
    """events: (key, us, id). Returns the set of (key, unit_no, n, first_us, last_us)."""
    by_key = {}
    for key, us, number in events:
        by_key.setdefault(key, []).append((us, number))
    return {
        (key, place, len(unit), unit[0][0], unit[-1][0])
        for key, rows in by_key.items()
        for place, unit in enumerate(walk_key(rows, size, idle, deadline), 1)
    }
