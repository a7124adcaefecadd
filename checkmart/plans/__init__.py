"""Layer plans: staging, fact, and the refresh jobs."""
