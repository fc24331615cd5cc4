import base64
import math
import random
import re
from collections import Counter

import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken

from tessera.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_rows_match_brute_force(spark, docs, empty):
    rng = random.Random(8)
    odd = ["a b c d e f g h " * 5, "same line\nsame line\n same line\n\n\n \n \nsame line", "#*$%&|<> " * 4, " ".join(rng.choice("ab") for _ in range(120)), "x " * 19, "x y z w " + " ".join(map(str, range(16))), "été\x1c ü ñ\x85a b"]
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()] + [(2000 + i, t, None) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = quality.measure(df).collect()
    want = []
    for d, t, _ in rows:
        c = plain(t)
        want.append((str(d), *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert sorted(want) == sorted((str(r.doc_id), *(r[c] for c in quality.COUNTS), r.base_failed) for r in got)
    assert all(not r.kept for r in got if r.base_failed)
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.count() == quality.measure(docs).where("kept").count()
    assert quality.measure(empty).count() == 0 and quality.accepted(empty).count() == 0
    assert quality.measure(df.select("doc_id", "text")).count() == len(rows)


def test_bands_reject_what_no_vocabulary_knows(spark):
    rng = random.Random(1)
    prose = "The river runs past the old mill and under three bridges before it meets the sea. People come in spring to watch boats leave, while children count gulls on the wall and their parents talk about weather, bread prices and the next village fair."
    noise = " ".join("".join(chr(rng.randrange(0x13000, 0x13400)) for _ in range(6)) for _ in range(60))
    same = " ".join("%%%%" * (1 + i * i % 97) for i in range(400))
    hexes = " ".join("%032x" % rng.getrandbits(128) for _ in range(60))
    df = spark.createDataFrame([(1, prose, "en"), (2, noise, "en"), (3, same, "en"), (4, hexes, "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.measure(df).collect()}
    assert got[1].kept and got[1].byte_share == 0 and not got[1].base_failed
    assert not got[2].kept and got[2].byte_share > 0.5 and not got[2].base_failed
    assert not got[4].kept and got[4].chars_per_token < 1.75
    assert not got[3].kept and got[3].entropy < 3


def test_measures_of_one_text():
    batch = pa.array(["to be or not to be"])
    words = quality.words_of(batch)
    m = quality.fertility(words, *quality._paths(None, None), quality.base_counts(batch, words)["word_chars"])
    assert abs(m["chars_per_token"][0] - 13 / 6) < 1e-9
    p = [2 / 6, 2 / 6, 1 / 6, 1 / 6]
    import math

    assert abs(m["entropy"][0] - -sum(x * math.log2(x) for x in p)) < 1e-9


#: The opening of the Universal Declaration of Human Rights or the like; Thai and Chinese with spaces between words.
PROSE = {
    "latin": "Všichni lidé se rodí svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím a mají spolu jednat v duchu bratrství. Každý má všechna práva a všechny svobody, stanovené touto deklarací.",
    "greek": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. Είναι προικισμένοι με λογική και συνείδηση, και οφείλουν να συμπεριφέρονται μεταξύ τους με πνεύμα αδελφοσύνης.",
    "cyrillic": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. Каждый человек имеет право на жизнь, на свободу и на личную неприкосновенность.",
    "armenian": "Բոլոր մարդիկ ծնվում են ազատ ու հավասար՝ իրենց արժանապատվությամբ և իրավունքներով։ Նրանք օժտված են բանականությամբ ու խղճով և պարտավոր են միմյանց նկատմամբ վարվել եղբայրության ոգով։ Յուրաքանչյուր ոք ունի կյանքի և ազատության իրավունք։",
    "georgian": "ყველა ადამიანი იბადება თავისუფალი და თანასწორი თავისი ღირსებითა და უფლებებით. მათ მინიჭებული აქვთ გონება და სინდისი და ერთმანეთის მიმართ უნდა იქცეოდნენ ძმობის სულისკვეთებით. ყოველ ადამიანს აქვს სიცოცხლის უფლება.",
    "hebrew": "כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו ברוח של אחווה. כל אדם זכאי לזכויות ולחרויות שנקבעו בהכרזה זו ללא הפליה כלשהי.",
    "arabic": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق، وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء. لكل إنسان حق التمتع بكافة الحقوق والحريات الواردة في هذا الإعلان دون أي تمييز.",
    "devanagari": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।",
    "bengali": "সমস্ত মানুষ স্বাধীনভাবে সমান মর্যাদা এবং অধিকার নিয়ে জন্মগ্রহণ করে। তাঁদের বিবেক এবং বুদ্ধি আছে; সুতরাং সকলেরই একে অপরের প্রতি ভ্রাতৃত্বসুলভ মনোভাব নিয়ে আচরণ করা উচিত। প্রত্যেকের জীবন ও স্বাধীনতার অধিকার আছে।",
    "tamil": "மனிதப் பிறவியினர் சகலரும் சுதந்திரமாகவே பிறக்கின்றனர்; அவர்கள் மதிப்பிலும் உரிமைகளிலும் சமமானவர்கள். அவர்கள் நியாயத்தையும் மனச்சாட்சியையும் இயற்பண்பாகப் பெற்றவர்கள். அவர்கள் ஒருவருடன் ஒருவர் சகோதர உணர்வுப் பாங்கில் நடந்துகொள்ளல் வேண்டும். எல்லோருக்கும் வாழும் உரிமை உண்டு.",
    "telugu": "మానవులందరు స్వతంత్రులుగానే జన్మించినారు. వారు గౌరవం విషయంలో, హక్కుల విషయంలో సమానులు. వారు తెలివి, మనస్సాక్షి కలిగిన వారు. వారు ఒకరి పట్ల ఒకరు సోదర భావంతో మెలగాలి. ప్రతి మనిషికి జీవించే హక్కు ఉంది.",
    "thai": "มนุษย์ ทั้งหลาย เกิดมา มี อิสระ และ เสมอภาค กัน ใน เกียรติศักดิ์ และ สิทธิ ต่าง มี เหตุผล และ มโนธรรม และ ควร ปฏิบัติ ต่อ กัน ด้วย เจตนารมณ์ แห่ง ภราดรภาพ",
    "hangul": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로 형제애의 정신으로 행동하여야 한다. 모든 사람은 생명과 신체의 자유와 안전에 대한 권리를 가진다.",
    "ethiopic": "የሰው ልጅ ሁሉ ሲወለድ ነጻና በክብርና በመብትም እኩልነት ያለው ነው። የተፈጥሮ ማስተዋልና ሕሊና ስላለው አንዱ ሌላውን በወንድማማችነት መንፈስ መመልከት ይገባዋል። እያንዳንዱ ሰው የመኖር ነጻነትና ደህንነት መብት አለው።",
    "han": "人人 生而 自由 ， 在 尊严 和 权利 上 一律 平等 。 他们 赋有 理性 和 良心 ， 并 应 以 兄弟 关系 的 精神 相 对待 。 人人 有 资格 享有 本 宣言 所载 的 一切 权利 和 自由 。",
    "kana": "すべての 人間は、 生まれながらに して 自由であり、 かつ、 尊厳と 権利とに ついて 平等である。 人間は、 理性と 良心とを 授けられて おり、 互いに 同胞の 精神を もって 行動しなければ ならない。 すべて 人は、 生命、 自由 及び 身体の 安全に 対する 権利を 有する。 何人も、 奴隷に されない。",
}


def test_clean_prose_of_every_script_is_kept(spark):
    rows = [(i, t, lang) for i, t in enumerate(PROSE.values()) for lang in (None, "xx")]
    rows.append((101, " ".join("%%%%" * (1 + i * i % 97) for i in range(400)), None))
    got = quality.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.doc_id for r in got if not r.kept and r.doc_id < 100} == set()
    assert not any(r.kept for r in got if r.doc_id == 101)


def test_script_of_a_text():
    names = {"han": "cjk", "kana": "cjk"}
    assert {k: quality.script(t) for k, t in PROSE.items()} == {k: names.get(k, k) for k in PROSE}
    assert [quality.script(t) for t in ("", "12 %", "Города 2024 abc", "ગુજરાતી", "\U00013000\U00013001")] == ["latin", "latin", "cyrillic", "*", "*"]


def plain_measures(text, lang):
    """The measures and the verdict of one whole text, word by word, from the vocabularies' own libraries."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def measures(words):
        tokens = [t for w in words for t in encoding.encode_ordinary(" " + w)]
        pieces = [p for w in words for p in model.encode(w)]
        share = sum(map(model.is_byte, pieces)) / max(1, len(pieces))
        entropy = -sum(n / len(tokens) * math.log2(n / len(tokens)) for n in Counter(tokens).values())
        return sum(map(len, words)) / max(1, len(tokens)), share, entropy, len(tokens)

    chars, share, entropy, n = measures(words)
    least, most, byte_share, part, bits = quality.BANDS[lang if lang in quality.BANDS else quality.script(text or "")]
    floor = bits if n >= 500 else part * math.log2(min(500, max(2, n)))
    c = plain(text)
    failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
    return chars, share, entropy, not failed and least <= chars <= most and share <= byte_share and entropy >= floor


def test_measures_and_verdicts_match_brute_force(spark):
    rng = random.Random(5)
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").limit(8).collect()
    rows = [(r.doc_id, (r.text or "")[:3000], r.lang) for r in some]
    rows += [(5000, " ".join(f"{rng.getrandbits(64):x}" for _ in range(40)), "en"), (5001, "\u5929\u6c17 " * 9 + "\U0001f600 " * 20, None), (5002, " ".join(rng.choices(["the", "mill", "of", "river"], k=700)), "xx"), (5003, None, "en"), (5004, "\U00013000\U00013001 " * 30, "de")]
    got = {r.doc_id: r for r in quality.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect()}
    for d, t, lang in rows:
        *want, kept = plain_measures(t, lang)
        assert all(abs(got[d][m] - w) < 1e-9 for m, w in zip(quality.MEASURES, want)) and got[d].kept == kept
    assert len({r.kept for r in got.values()}) == 2
