import pytest

from ridgeline.llm import near_dedup


@pytest.mark.parametrize("percent", [50, 79, 101])
def test_percent_that_would_lose_links_is_refused(odd_docs, percent):
    for run in (near_dedup.near_duplicates, near_dedup.without_near_duplicates):
        with pytest.raises(ValueError, match="percent"):
            run(odd_docs, percent=percent)
