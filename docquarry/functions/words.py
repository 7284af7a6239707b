"""Numbers for the words of Arrow text batches, for use inside Python functions of Spark."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What `str.split` splits at, but for the plain space.
_OTHER_WHITESPACE = "[\t-\r\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def word_values(texts: pa.Array, value: Callable[[str], int], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(ends, values): the value of every word, and where each text's words end.

    The words are those of `functions.text.words`; a null text has none. Each word of the
    batch is valued once, however often it stands there.
    """
    split = pc.split_pattern(pc.replace_substring_regex(texts, _OTHER_WHITESPACE, " "), " ")
    ends = np.cumsum(np.r_[0, split.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)])
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    different = coded.dictionary
    values = np.fromiter(map(value, different.to_numpy(zero_copy_only=False)), kind, len(different))[codes]
    empty = different.index("").as_py()
    if empty >= 0:
        kept = codes != empty
        ends, values = np.r_[0, np.cumsum(kept)][ends], values[kept]
    return ends, values
