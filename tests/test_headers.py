from skyledger.sources import files


def test_long_header_is_read_to_its_end(spark, tmp_path):
    def write(name, n):
        cards = ["SIMPLE  =                    T", *(f"HISTORY line {k} END     " for k in range(n)), "LAST    =                   42 / beyond", "END"]
        text = "".join(c.ljust(80) for c in cards)
        (tmp_path / name).write_bytes(text.ljust(-len(text) % 2880 + len(text)).encode() + bytes(2880))

    write("short.fits", 10)
    write("long.fits", 4000)
    got = {r.path.rsplit("/", 1)[1]: r.cards for r in files.image_headers(spark, str(tmp_path)).collect()}
    for name, n in (("short.fits", 10), ("long.fits", 4000)):
        assert (got[name][n + 1].key, got[name][n + 1].value) == ("LAST", "42") and len(got[name]) == n + 2
