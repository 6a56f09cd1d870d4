"""Sentences of scripts without spaces."""

import pytest

from kornverk.llm.sentences import iter_sentences


@pytest.mark.parametrize(
    "parts",
    [
        ["今日は検査をしました", "患者さんは安心しています", "来週また来ます"],
        ["検査をしましたか", "先生は何も言いませんでした"],
        ["検査をしました", "7時に帰りました"],
        ["现在还疼吗", "我们今天做检查。"],
        ["兄は結果を説明しましたが心配です"],
        ["症状はますます悪化しています"],
        ["検査をしました場合は電話します。"],
        ["母が励ます患者さんは元気です。"],
        ["病人用了吗啡今天好多了。"],
        ["医生看了她的伤口。"],
    ],
)
def test_words_of_a_spaceless_run_close_a_sentence(parts):
    assert list(iter_sentences("".join(parts))) == parts


def test_spaces_between_closed_sentences():
    parts = ["検査をしました", "患者さんは安心しています", "7時に帰りました"]
    assert list(iter_sentences(" ".join(parts))) == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["ผู้ป่วยมา", "7", "โมงเช้า"],
        ["แพทย์ให้ยา", "Paracetamol 500 mg", "ทุกวัน"],
        ["ผู้ป่วยบอกว่า", "«ฉันปวดหัว มาก»", "แล้วกลับบ้าน"],
        ["แพทย์ตรวจ", "(ไข้สูง)", "แล้วสั่งยา"],
        ["Paracetamol", "ช่วยลดไข้", "แต่อาการยังไม่ดีขึ้น"],
        ["แพทย์: สวัสดี", "คุณเป็นอย่างไร"],
        ["1. ผู้ป่วยปวดหัว", "แพทย์ตรวจ"],
        ["Pasienten sa สวัสดี og gikk hjem igjen."],
        ["Pasienten kom sent.", "ผู้ป่วยมา", "7", "โมง"],
    ],
)
def test_spaces_of_a_thai_stretch(parts):
    assert list(iter_sentences(" ".join(parts))) == parts
