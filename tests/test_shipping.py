"""Python helpers reach executors that do not have the package."""

import subprocess
import sys

from pyspark import cloudpickle

from tablewright.functions.special import t_two_sided
from tablewright.operators.regression import solve


def test_helpers_travel_with_the_task(tmp_path):
    payload = tmp_path / "f.bin"
    payload.write_bytes(cloudpickle.dumps((solve, t_two_sided)))
    code = ("import pickle, sys; s, t = pickle.load(open(sys.argv[1], 'rb')); "
            "print(s(4, [1.0, 2.0], [1.0, 2.0, 4.0])['coef'][0], 'tablewright' in sys.modules)")
    out = subprocess.run([sys.executable, "-c", code, str(payload)], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["2.0", "False"]
