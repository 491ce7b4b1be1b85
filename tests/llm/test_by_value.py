"""Workers need no copy of the library for what the operators send them."""

import subprocess
import sys

from pyspark import cloudpickle

from pledgemart.llm import common, simhash


def test_staging_goes_by_value(tmp_path):
    (tmp_path / "sent").write_bytes(cloudpickle.dumps((common.stage, simhash)))
    read = "import sys; from pyspark import cloudpickle; cloudpickle.loads(open(sys.argv[1], 'rb').read()); assert 'pledgemart' not in sys.modules"
    subprocess.run([sys.executable, "-I", "-c", read, tmp_path / "sent"], check=True, cwd="/")
