"""The slicer against the reference's 24 golden cases (FIXTURES.md A1), pure Python."""

import pytest

from parlance.operators.slicing import Seg, slice_segments

O = None  # open segment: start only

# (name, segments [(start, end, text, scores)], duration, threshold,
#  expected [(seek, [(start, end or O, text or O)])])
CASES = [
    ("first_zero_len_segment_skipped", [(0, 0, "Zero", []), (15, 20, "Hello", [])], 30, 0,
     [(15, [(0, 5, "Hello")])]),
    ("last_zero_len_segment_skipped", [(15, 20, "Hello", []), (40, 40, "Zero", [])], 30, 0,
     [(0, [(15, 20, "Hello")])]),
    ("mid_zero_len_segment_skipped", [(15, 20, "Hello", []), (35, 35, "Zero", []), (40, 45, "World", [])], 45, 0,
     [(0, [(15, 20, "Hello")]), (40, [(0, 5, "World")])]),
    ("basic_two_segments", [(0, 10, "Hello", []), (15, 20, "World", [])], 30, 0,
     [(0, [(0, 10, "Hello"), (15, 20, "World")])]),
    ("last_segment_cross_over", [(0, 10, "Hello", []), (15, 35, "World", [])], 40, 0,
     [(0, [(0, 10, "Hello"), (15, O, O)]), (10, [(5, 25, "World")])]),
    ("last_segment_cross_over_single_crossed_over", [(0, 10, "Hello", []), (50, 70, "World", [])], 70, 0,
     [(0, [(0, 10, "Hello")]), (30, []), (50, [(0, 20, "World")])]),
    ("segment_end_over_audio_duration", [(0, 35, "Hello", [])], 30, 0, []),
    ("basic_single_segment_in_a_single_slice", [(0, 5, "Hello", [])], 10, 0, [(0, [(0, 5, "Hello")])]),
    ("first_slice_empty", [(35, 45, "Hello", [])], 45, 0, [(0, []), (30, [(5, 15, "Hello")])]),
    ("last_slice_empty", [(5, 15, "Hello", [])], 45, 0, [(0, [(5, 15, "Hello")]), (30, [])]),
    ("low_quality_slice_dropped_last_seg_low_quality",
     [(5, 15, "Hello", [0.9]), (20, 29, "low", [0.1])], 45, 0.8, [(0, [])]),
    ("low_quality_slice_dropped_first_seg_low_quality",
     [(5, 15, "low", [0.1]), (20, 35, "Hello", [0.9])], 45, 0.4, [(0, []), (20, [(0, 15, "Hello")])]),
    ("low_quality_slice_dropped_mid_seg_low_quality",
     [(5, 10, "Hello", [0.8]), (15, 20, "low", [0.1]), (20, 21, "low", [0.1]), (21, 22, "low", [0.1]),
      (22, 23, "low", [0.1]), (25, 30, "World", [0.8])], 30, 0.8, [(0, []), (25, [(0, 5, "World")])]),
    ("low_quality_slice_dropped_cross_over_good_quality",
     [(5, 10, "Hello", [0.8]), (15, 20, "low", [0.7]), (20, 21, "low", [0.7]), (21, 22, "low", [0.6]),
      (22, 23, "low", [0.6]), (23, 23, "low", [0.6]), (25, 35, "World", [0.8])], 35, 0.7,
     [(0, []), (15, []), (20, []), (25, [(0, 10, "World")])]),
    ("low_quality_slice_dropped_no_good_quality_in_slice",
     [(5, 10, "Hello", [0.8]), (15, 20, "low", [0.1]), (20, 21, "low", [0.1]), (21, 22, "low", [0.1]),
      (22, 23, "low", [0.1]), (35, 45, "World", [0.9])], 45, 0.8, [(0, []), (35, [(0, 10, "World")])]),
    ("low_quality_slice_dropped_not_the_first_slice",
     [(5, 10, "Hello", [0.8]), (20, 30, "World", [0.9]), (32, 33, "low", [0.1]), (33, 34, "low", [0.1]),
      (34, 35, "low", [0.1]), (35, 36, "low", [0.1]), (36, 37, "high", [0.9])], 45, 0.8,
     [(0, [(5, 10, "Hello"), (20, 30, "World")]), (30, []), (36, [(0, 1, "high")])]),
    ("quality_score_filter_does_not_include_crossed_over_segments",
     [(2, 10, "a b c", [0.8, 0.7, 0.6]), (29, 34, "d e", [0.5, 0.4])], 40, 0.7,
     [(0, [(2, 10, "a b c"), (29, O, O)]), (10, [])]),
    ("twice_crossed_over_push", [(2, 4, "Hello", [0.9]), (29, 35, "World", [0.9])], 40, 0.5,
     [(0, [(2, 4, "Hello"), (29, O, O)]), (4, []), (29, [(0, 6, "World")])]),
    ("too_long_for_any_slice_alone", [(2, 35, "Hello", [0.9])], 40, 0.5, []),
    ("too_long_for_any_slice_cross_over", [(2, 4, "Hello", [0.9]), (29, 60, "World", [0.9])], 62, 0.5,
     [(0, [(2, 4, "Hello"), (29, O, O)])]),
    ("too_long_for_any_slice_continues_normally", [(2, 35, "Hello", [0.9]), (36, 56, "World", [0.9])], 60, 0.5,
     [(36, [(0, 20, "World")])]),
    ("audio_duration_shorter_than_slice_length", [(5, 10, "Hello", []), (15, 20, "World", [])], 15, 0,
     [(0, [(5, 10, "Hello")])]),
    ("zero_audio_duration", [(5, 10, "Hello", []), (15, 20, "World", [])], 0, 0, []),
    ("gathers_all_word_scores_of_segments",
     [(2, 8, "Hello Again", [0.9, 0.8]), (31, 38, "Dear World", [0.7, 0.6])], 40, 0.5,
     [(0, [(2, 8, "Hello Again")]), (30, [(1, 8, "Dear World")])]),
]


@pytest.mark.parametrize("name,segs,dur,thr,expected", CASES, ids=[c[0] for c in CASES])
def test_slicer_golden(name, segs, dur, thr, expected):
    got = list(slice_segments([Seg(*s) for s in segs], dur, 30, thr))
    assert len(got) == len(expected), got
    for (seek, out), (eseek, eout) in zip(got, expected):
        assert seek == eseek
        assert [(s["start"], s.get("end"), s.get("text")) for s in out] == eout
    # closed segments carry their input scores unchanged
    by_text = {t: sc for _, _, t, sc in segs}
    for _, out in got:
        for s in out:
            if "text" in s:
                assert s["word_scores"] == by_text[s["text"]]
