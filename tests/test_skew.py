"""Regression guard for skew: a third of all rows on one station must not land in one reducer.

Runs tools/skew_check.py in a child process (it needs its own event log) on the sf0.01 tables.
"""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_station_is_spread_across_reducers():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), "/root/testdata/sf0.01"],
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    rows = re.findall(r"^(.*): stage \d+: tasks=(\d+) .* max/total=([\d.]+)%$", out.stdout, re.M)
    reducers = [(label, float(share)) for label, tasks, share in rows if int(tasks) >= 16]
    ours = [s for label, s in reducers if not label.startswith("contrast")]
    contrast = [s for label, s in reducers if label.startswith("contrast")]
    assert ours and contrast, out.stdout
    assert max(ours) < 8.0, out.stdout          # even split over 32 reducers is 3.1 %
    assert max(contrast) > 25.0, out.stdout     # the station-only layout does concentrate the hot key
