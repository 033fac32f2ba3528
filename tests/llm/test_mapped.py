import os

import numpy as np
import pytest

from millrace.llm import mapped


def test_only_unwritten_numbers_are_empty(tmp_path):
    folder = str(tmp_path / "a")
    for n in (0, 2):
        mapped.write_array(folder, f"keys-{n}", np.array([n * 10, n * 10 + 1], "<u8"))
        mapped.write_thin(folder, f"values-{n}", np.array([[1, 2], [1 << 40, 3]], "<u8"))
    mapped.write_places(folder, "keys", [2, 0])
    keys, files = np.array([0, 1, 5, 20, 21], np.uint64), np.array([0, 0, 1, 2, 2])
    found = mapped.look_up(folder, keys, files, ("keys", "<u8"), ("values", mapped.THIN, 2))
    assert found.tolist() == [[1, 2], [1 << 40, 3], [0, 0], [1, 2], [1 << 40, 3]]
    other = str(tmp_path / "b")
    os.rename(folder, other)
    os.remove(f"{other}/keys-2")
    with pytest.raises(FileNotFoundError):
        mapped.look_up(other, keys, files, ("keys", "<u8"), ("values", mapped.THIN, 2))
    with pytest.raises(FileNotFoundError):
        mapped.look_up(str(tmp_path / "c"), keys, files, ("keys", "<u8"), ("values", mapped.THIN, 2))
