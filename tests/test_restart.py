"""A query built after the session is stopped and a new one started must not
reuse scans of the dead session (run in a subprocess: it stops its session)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
sys.path.insert(0, %r)
from opscore.session import local_session
from opscore import registry
s = local_session(2, 4)
a = registry.queries()['route_demand'](s, '/root/testdata/sf0.001').count()
s.stop()
s2 = local_session(2, 4)
b = registry.queries()['route_demand'](s2, '/root/testdata/sf0.001').count()
print('COUNTS', a, b)
""" % ROOT


def test_new_session_after_stop():
    out = subprocess.run([sys.executable, "-c", CODE], capture_output=True, text=True,
                         timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("COUNTS")]
    assert line, out.stderr[-2000:]
    _, a, b = line[0].split()
    assert a == b and int(a) > 0
