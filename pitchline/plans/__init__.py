"""pitchline.plans"""
