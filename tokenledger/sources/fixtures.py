"""Fixed inputs whose values must equal the reference experiments.

These are data, not logic: the three training corpora, the five
equal-meaning test sentences, the eight bolt-on vocabulary lists and the
corpus mixes.  They are kept verbatim and in their original order; only
whitespace inside the corpora is irrelevant (training splits on it).

They back the golden tests and the small-sample reports.  Registered
queries always run over the driver tables; these lists only join them
(vocabulary) or provide the published tokenizer (see ``sources.rules``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference experiments; do not edit)
# ---------------------------------------------------------------------------

ENGLISH_CORPUS = """
The quick brown fox jumps over the lazy dog. The dog was sleeping
in the sun while the fox was running through the forest. The forest
was green and full of trees and the trees were tall and the leaves
were green. The sun was shining and the birds were singing and the
wind was blowing through the trees. The fox jumped over the fence
and ran into the field. The field was large and open and the grass
was tall. The farmer was working in the field and the dog was
watching the farmer. The quick brown fox jumps over the lazy dog
again and again. The dog barked at the fox and the fox ran away.
Payment processing is important for global commerce. Users sign up
and create accounts to access subscription services. The billing
system processes credit cards and digital payments every month.
The customer enters their email address and password to register.
Free trial starts immediately after the account is created.
"""

JAPANESE_CORPUS = """
素早い茶色の狐が怠惰な犬を飛び越える。犬は太陽の下で寝ていた。
狐は森を走っていた。森は緑で木がたくさんあった。
"""

CHINESE_CORPUS = """
敏捷的棕色狐狸跳过了懒惰的狗。狗在阳光下睡觉。
狐狸在森林里奔跑。森林是绿色的，有很多树木。
"""

# Equal-meaning test sentences, in the order the first experiment prints them.
PARALLEL_SENTENCES = [
    ("English", "The user creates an account and starts a free trial"),
    ("Japanese", "ユーザーがアカウントを作成して無料トライアルを開始する"),
    ("French", "L'utilisateur crée un compte et commence un essai gratuit"),
    ("Chinese", "用户创建账户并开始免费试用"),
    ("Korean", "사용자가 계정을 만들고 무료 체험을 시작합니다"),
]
BASELINE_LANGUAGE = "English"

# Corpus mixes: (source, weight) in corpus order; every mix trains 80 merges.
CORPUS_MIXES = {
    "heavy": [("en", 3), ("ja", 1)],
    "balanced_ja": [("en", 1), ("ja", 10)],
    "balanced_zh": [("en", 1), ("zh", 10)],
}
NUM_MERGES = 80

# Bolt-on vocabulary lists, in the order they are added.  Character lists are
# given as one string (each character is one entry).
CHINESE_COMMON_CHARS = (
    "的一是不了人我在有他这中大来上个国到说们为子和你地出会也时要就"
    "可以生那都好过没自家学多么经年得就着两把用道行所然而事对于"
    "想开下面天无四方作起好还发成只如第已新最长现知前很"
    "但信被从那些明月什全"
)
CHINESE_COMMON_BIGRAMS = [
    "我们", "他们", "她们", "什么", "这个", "那个", "可以", "已经",
    "因为", "所以", "但是", "如果", "虽然", "还是", "或者", "不是",
    "没有", "知道", "时候", "现在", "开始", "工作", "问题", "中国",
    "世界", "国家", "公司", "系统", "用户", "账户", "创建", "免费",
    "试用", "服务", "支付", "处理", "数据", "信息", "安全", "技术",
]
JAPANESE_HIRAGANA = (
    "あいうえおかきくけこさしすせそたちつてとなにぬねの"
    "はひふへほまみむめもやゆよらりるれろわをん"
    "がぎぐげござじずぜぞだぢづでどばびぶべぼぱぴぷぺぽ"
)
JAPANESE_KATAKANA = (
    "アイウエオカキクケコサシスセソタチツテトナニヌネノ"
    "ハヒフヘホマミムメモヤユヨラリルレロワヲン"
    "ガギグゲゴザジズゼゾダヂヅデドバビブベボパピプペポ"
)
JAPANESE_COMMON_WORDS = [
    "ユーザー", "アカウント", "トライアル", "サービス",
    "システム", "データ", "セキュリティ",
    "する", "した", "して", "される", "できる",
    "ある", "いる", "なる", "おる",
    "です", "ます", "ました", "ません",
    "この", "その", "あの", "どの",
    "から", "まで", "より", "ため",
    "こと", "もの", "ところ", "ほう",
    "無料", "開始", "作成", "登録", "確認",
]
KOREAN_COMMON_CHARS = (
    "이다는을의가에서한와로도를하고자사나대있었으면"
    "어그런까지만아요해제스시들것입저리들어오세계"
)
FRENCH_ACCENTED_CHARS = "éèêëàâäùûüôöîïçæœÉÈÊËÀÂÄÙÛÜÔÖÎÏÇÆŒ"
FRENCH_COMMON_WORDS = [
    "créer", "crée", "créé", "début", "déjà", "après", "très",
    "être", "même", "système", "problème", "général", "spécial",
    "résultat", "différent", "intéressant", "nécessaire",
    "également", "évidemment", "immédiatement",
    "utilisateur", "compte", "essai", "gratuit", "commencer",
    "inscription", "connexion", "mot de passe", "adresse",
    "avec", "dans", "pour", "plus", "mais", "cette", "tout",
    "nous", "vous", "leur", "sont", "elle", "aussi", "comme",
    "peut", "fait", "bien", "encore", "entre", "sans",
]

# (label, entries) in the order the all-languages tokenizer adds them.
VOCAB_GROUPS = [
    ("ZH-char", list(CHINESE_COMMON_CHARS)),
    ("ZH-bigram", CHINESE_COMMON_BIGRAMS),
    ("JA-hiragana", list(JAPANESE_HIRAGANA)),
    ("JA-katakana", list(JAPANESE_KATAKANA)),
    ("JA-word", JAPANESE_COMMON_WORDS),
    ("KO-char", list(KOREAN_COMMON_CHARS)),
    ("FR-accent", list(FRENCH_ACCENTED_CHARS)),
    ("FR-word", FRENCH_COMMON_WORDS),
]

# Tokenizer variants: which vocabulary groups each one adds (by label).
VOCAB_VARIANTS = {
    "zh": ["ZH-char", "ZH-bigram"],
    "ja": ["JA-hiragana", "JA-katakana", "JA-word"],
    "fr": ["FR-accent", "FR-word"],
    "all": ["ZH-char", "ZH-bigram", "JA-hiragana", "JA-katakana", "JA-word",
            "KO-char", "FR-accent", "FR-word"],
}

# Cost model: price per token and the number of times a text is sent.
PRICE_PER_TOKEN = 2.50 / 1_000_000
SEND_VOLUME = 1_000_000

# ---------------------------------------------------------------------------

CORPORA = {"en": ENGLISH_CORPUS, "ja": JAPANESE_CORPUS, "zh": CHINESE_CORPUS}

CORPUS_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("source_ord", T.IntegerType(), False),
    T.StructField("doc_ord", T.LongType(), False),
    T.StructField("weight", T.LongType(), False),
    T.StructField("text", T.StringType(), True),
])

PARALLEL_SCHEMA = T.StructType([
    T.StructField("group_id", T.IntegerType(), False),
    T.StructField("lang_ord", T.IntegerType(), False),
    T.StructField("lang", T.StringType(), False),
    T.StructField("text", T.StringType(), True),
])

VOCAB_IN_SCHEMA = T.StructType([
    T.StructField("group_ord", T.IntegerType(), False),
    T.StructField("item_ord", T.IntegerType(), False),
    T.StructField("term", T.StringType(), True),
    T.StructField("label", T.StringType(), False),
])


def reference_corpus_mix(spark: SparkSession, mix: str) -> DataFrame:
    """One of the reference training mixes as ``(source, source_ord, doc_ord, weight, text)``."""
    from tokenledger.sources.tables import union_corpora

    parts = [(src, spark.createDataFrame([(CORPORA[src],)], "text string"), w)
             for src, w in CORPUS_MIXES[mix]]
    return union_corpora(parts)


def parallel_sentences(spark: SparkSession) -> DataFrame:
    rows = [(0, i, lang, text) for i, (lang, text) in enumerate(PARALLEL_SENTENCES)]
    return spark.createDataFrame(rows, PARALLEL_SCHEMA)


def vocab_rows(labels: list[str] | None = None) -> list[tuple[int, int, str, str]]:
    """Vocabulary input rows ``(group_ord, item_ord, term, label)``.

    ``labels`` picks and orders the groups (a tokenizer variant); default all.
    """
    groups = dict(VOCAB_GROUPS)
    order = labels if labels is not None else [g for g, _ in VOCAB_GROUPS]
    rows = []
    for g_ord, label in enumerate(order):
        for i_ord, term in enumerate(groups[label]):
            rows.append((g_ord, i_ord, term, label))
    return rows


def vocab_input(spark: SparkSession, labels: list[str] | None = None) -> DataFrame:
    return spark.createDataFrame(vocab_rows(labels), VOCAB_IN_SCHEMA)
