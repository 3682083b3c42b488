"""The ad-click stream: one pipeline with feedback, and native stateful counts."""
