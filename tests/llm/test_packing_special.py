import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from glossaria.llm import packing as p


def test_added_tokens_in_texts_are_encoded_as_the_library_does(spark):
    mark = "<|endoftext|>"
    texts = [f"hello {mark} x", f"in{mark}side a word", mark, f"{mark} {mark}{mark}  {mark}\n{mark} end", f"a  {mark} b", f"ends {mark}", "<|endof text|>", f"ä {mark}é 漢{mark}字"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(p.VOCABULARY))
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, p.END_ID] for t in texts]
    assert want[0] == [31373, 220, 50256, 2124, 0]
    rows = p.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in rows} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in enumerate(want)}
