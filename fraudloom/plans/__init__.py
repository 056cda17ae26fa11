"""Plan shapes that keep ordered work spread out when keys are skewed."""
