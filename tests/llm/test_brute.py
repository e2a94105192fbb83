"""Learned operators against plain loops over what they have learned."""

import math

from chunkloom.llm import language_id, toxicity

SF = "/root/testdata/sf0.001"


def test_languages_by_a_loop_over_dictionaries(spark):
    import zstandard

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = language_id.learn(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(90001, None), (90002, ""), (90003, "12 34 %"), (90004, "ΑΒΓ δε"), (90005, "the and " * 5000)]

    def plain(text):
        words, word = [], ""
        for c in text.lower():
            if c.isalpha() or ord(c) > 127:
                word += c
            else:
                words, word = [*words, word] if word else words, ""
        return " ".join([*words, word] if word else words).encode()

    def predicted(text):
        if not text or not any(c.isalpha() for c in text):
            return "und", 0.0
        data, sizes = plain(text), []
        for lang, raw in dictionaries.items():
            own = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes.append((sum(len(own.compress(data[k : k + 4096])) for k in range(0, max(1, len(data)), 4096)), lang))
        sizes.sort()
        return sizes[0][1], 1 - math.exp(-20 * (sizes[1][0] - sizes[0][0]) / sizes[0][0])

    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_id.classify(frame, dictionaries).collect()}
    want = {i: (lang, round(score, 9)) for i, t in rows for lang, score in [predicted(t)]}
    assert got == want and len(dictionaries) > 1


def test_toxicity_by_a_scan_of_every_start(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    entries, slope, offset = toxicity.learn(docs, labels)
    texts = [r.text for r in docs.collect()] + [None, "", "You IDIOT, you m0ron", "scum of the earth, i d i o t", *(f"well {p} then" for p in toxicity.EXCEPTIONS)]

    def score(text):
        total = 0.0
        if text:
            folded = toxicity.fold(text)
            masked = set()
            for p in toxicity.EXCEPTIONS:
                at = folded.find(f" {p} ")
                while at >= 0:
                    masked |= set(range(at, at + len(p) + 1))
                    at = folded.find(f" {p} ", at + 1)
            for at, c in enumerate(folded):
                found = [e for e in entries if c == " " and folded.startswith(e, at + 1)]
                if found and at not in masked:
                    total += entries[max(found, key=len)]
            total /= math.log(math.e + folded.count(" "))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * total + offset))))

    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: round(r.score, 9) for r in toxicity.score_texts(frame, (entries, slope, offset)).collect()}
    want = {k: round(score(t), 9) for k, t in enumerate(texts)}
    assert got == want and any(w > 0.5 for w in want.values()) and any(w < 0.5 for w in want.values())
