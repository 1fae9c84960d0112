"""Python functions reach executors that do not have the package."""

import subprocess
import sys

from pyspark import cloudpickle

from tallyline.functions import text
from tallyline.operators import pairing


def test_functions_travel_with_their_code(tmp_path):
    code = "import pickle, sys; f = pickle.load(sys.stdin.buffer); print(f.__name__, 'tallyline' in sys.modules)"
    for fn in (pairing._transitions, pairing._chain, pairing._replay, text._nfd.func):
        ran = subprocess.run(
            [sys.executable, "-c", code], input=cloudpickle.dumps(fn), cwd=tmp_path, capture_output=True, timeout=120
        )
        assert ran.stdout.decode().split() == [fn.__name__, "False"], ran.stderr.decode()
