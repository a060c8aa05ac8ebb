"""Per-user list of the newest ratings as streaming state (worker-side functions)."""

import heapq

import pandas as pd

STATE_SCHEMA = "event_id array<long>, mid array<int>, score array<double>, timestamp array<int>"
OUTPUT_SCHEMA = (
    "uid int, event_id long, mid int, timestamp int, "
    "recent_ids array<long>, recent_mids array<int>, recent_scores array<double>"
)


def newest_per_user(keep):
    """Stateless map-side cut: a batch forwards at most ``keep`` rows per user, its newest.

    Older rows of the same batch can never be among the newest ``keep`` overall, so a user who
    sends a third of all ratings does not send them through the shuffle.
    """

    def cut(frames):
        for frame in frames:
            newest = frame.sort_values(["timestamp", "event_id"], ascending=False, kind="stable")
            yield newest.groupby("uid", sort=False).head(keep)

    return cut


def fold_recent(keep):
    """State update: merge a user's new ratings chunk by chunk, never holding more than needed."""

    def fold(key, frames, state):
        newest = []
        if state.exists:
            ids, mids, ratings, times = state.get
            newest = list(zip(times, ids, mids, ratings))
        trigger = None
        for frame in frames:
            fresh = list(zip(*(frame[c].tolist() for c in ("timestamp", "event_id", "mid", "score"))))
            newest = heapq.nlargest(keep, newest + fresh)
            trigger = max(fresh + ([trigger] if trigger else []))
        if trigger is None:
            return
        times, ids, mids, ratings = ([row[i] for row in newest] for i in range(4))
        state.update((ids, mids, ratings, times))
        yield pd.DataFrame(
            {
                "uid": [int(key[0])],
                "event_id": [trigger[1]],
                "mid": [trigger[2]],
                "timestamp": [trigger[0]],
                "recent_ids": [ids],
                "recent_mids": [mids],
                "recent_scores": [ratings],
            }
        )

    return fold
