"""Build logscan.zip for ``spark-submit --py-files``.

usage: python tools/package.py [out_dir]   (prints the zip path)
"""

import os
import sys
import zipfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main(out_dir: str) -> str:
    path = os.path.join(out_dir, "logscan.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, _, files in os.walk(os.path.join(ROOT, "logscan")):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    zf.write(full, os.path.relpath(full, ROOT))
    return path


if __name__ == "__main__":
    print(main(sys.argv[1] if len(sys.argv) > 1 else "."))
