"""Plain-Python models the operators are compared with."""

KEY = ["JOURNAL_ID", "STUDENT_ID", "LESSON_ID", "LESSON_DATE"]


def arbitrate(requests, history=()):
    """{ID: reason or None}, walking the requests of each key in order."""
    standing = {}
    for h in sorted(history, key=lambda r: (r["DATE_CREATE"], r["ID"])):
        if h["TYPE_MARK"] == 0:
            standing[tuple(h[k] for k in KEY)] = h
    verdicts = []
    for r in sorted(requests, key=lambda r: (r["DATE_CREATE"], r["ID"])):
        key = tuple(r[k] for k in KEY)
        old = standing.get(key)
        employee, monitor = r["MARKED_BY_ROLE"] in (2, 3), r["MARKED_BY_ROLE"] == 1
        if r["MARKED_BY_ROLE"] not in (0, 1, 2, 3):
            reason = "unknown_role"
        elif old is None:
            reason = None
        else:
            same_marker = old["MARKED_BY"] == r["MARKED_BY"]
            same_mark = old["ATTENDANCE_MARK"] == r["ATTENDANCE_MARK"]
            if employee:
                reason = "same_value" if same_marker and same_mark else None
            elif old["MARKED_BY_ROLE"] in (2, 3):
                reason = "teacher_mark"
            elif monitor:
                reason = "same_value" if same_marker and same_mark else None
            elif old["MARKED_BY_ROLE"] == 1 and not same_marker:
                reason = "monitor_mark"
            elif not same_marker:
                reason = "other_user"
            else:
                reason = "same_value" if same_mark else None
        verdicts.append((r["ID"], reason))
        if reason is None:
            standing[key] = r
    return dict(verdicts)


def latest(rows):
    """Newest row per key."""
    best = {}
    for r in rows:
        key = tuple(r[k] for k in KEY)
        if key not in best or (r["DATE_CREATE"], r["ID"]) > (best[key]["DATE_CREATE"], best[key]["ID"]):
            best[key] = r
    return best
