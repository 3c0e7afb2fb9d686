from glossaria.llm import webp as w


def test_lines_that_repeat_beyond_the_farthest_distance():
    line = "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVW"
    for text in ("\n".join([line] * 21_000), "\n".join([line, *(f"{i:07d} filler of a long text" for i in range(31_768)), line, line, "end"] * 2)):
        payload = w.padded(text)
        assert len(payload) > 1 << 20
        assert w.load_bytes(w.store_bytes(payload)) == payload
