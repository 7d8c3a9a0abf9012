"""Spellings of place names: folds of variants, readings in kana and in Latin letters."""

from __future__ import annotations

import re
import unicodedata

#: Old and variant characters with their usual forms.
VARIANTS = {
    "龍": "竜", "廣": "広", "圓": "円", "櫻": "桜", "澤": "沢", "瀧": "滝", "嶽": "岳", "峯": "峰", "黑": "黒", "鹽": "塩", "鐵": "鉄", "濱": "浜",
    "邊": "辺", "邉": "辺", "國": "国", "島": "島", "嶋": "島", "嶌": "島", "﨑": "崎", "齋": "斎", "齊": "斉", "髙": "高", "惠": "恵", "眞": "真",
    "嶺": "峰", "蟬": "蝉", "戀": "恋", "會": "会", "藏": "蔵", "檜": "桧", "螢": "蛍", "靑": "青", "縣": "県", "鷄": "鶏", "戶": "戸", "萬": "万",
}
FOLD = str.maketrans(VARIANTS)
SMALL_TSU = "っ"

#: The syllables of Hepburn romanisation.
SYLLABLES = dict(
    zip(
        "あ い う え お か き く け こ が ぎ ぐ げ ご さ し す せ そ ざ じ ず ぜ ぞ た ち つ て と だ ぢ づ で ど な に ぬ ね の は ひ ふ へ ほ ば び ぶ べ ぼ ぱ ぴ ぷ ぺ ぽ ま み む め も や ゆ よ ら り る れ ろ わ を ん "
        "きゃ きゅ きょ ぎゃ ぎゅ ぎょ しゃ しゅ しょ じゃ じゅ じょ ちゃ ちゅ ちょ にゃ にゅ にょ ひゃ ひゅ ひょ びゃ びゅ びょ ぴゃ ぴゅ ぴょ みゃ みゅ みょ りゃ りゅ りょ".split(),
        "a i u e o ka ki ku ke ko ga gi gu ge go sa shi su se so za ji zu ze zo ta chi tsu te to da ji zu de do na ni nu ne no ha hi fu he ho ba bi bu be bo pa pi pu pe po ma mi mu me mo ya yu yo ra ri ru re ro wa o n "
        "kya kyu kyo gya gyu gyo sha shu sho ja ju jo cha chu cho nya nyu nyo hya hyu hyo bya byu byo pya pyu pyo mya myu myo rya ryu ryo".split(),
    )
)

HIRAGANA = {c: c - 0x60 for c in range(ord("ァ"), ord("ヷ"))}


def hiragana(text: str) -> str:
    return text.translate(HIRAGANA)


def fold(text: str) -> str:
    """One form for the spellings of a written name: NFKC, lower case, usual characters, one sign for no and for ga, no blanks."""
    text = re.sub(r"\s+", "", unicodedata.normalize("NFKC", text).lower().translate(FOLD))
    if re.search(r"[一-鿿々]", text):
        text = re.sub(r"(?<=[一-鿿々])[乃之のノ](?=[一-鿿々])", "ノ", text)
        text = re.sub(r"(?<=[一-鿿々])[がヶケカヵガ](?=[一-鿿々]|$)", "ヶ", text)
    return text


def romaji(kana: str) -> str:
    out, i, double = [], 0, False
    while i < len(kana):
        for size in (2, 1):
            if (s := SYLLABLES.get(kana[i : i + size])) is not None:
                out.append((("t" if s[:2] == "ch" else s[0]) if double else "") + s)
                double, i = False, i + size
                break
        else:
            if kana[i] == SMALL_TSU:
                double = True
            elif kana[i] == "ー" and out:
                out.append(out[-1][-1])
            i += 1
    return "".join(out)


def latin(text: str) -> str:
    """Latin letters alone, long vowels written short."""
    text = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if "a" <= c <= "z")
    return re.sub(r"ou|oo+|ō", "o", re.sub(r"uu+", "u", text))
